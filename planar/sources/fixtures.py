"""Point and box views over the generated test tables (see FIXTURES.md).

The tables hold no geometry, so each view maps two or four numeric
columns to coordinates.  The same views are written as DuckDB CTEs in
``SQL_VIEWS`` for the oracle queries; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's DataFrame, defined once per session (reading a parquet
    schema costs a footer read; the DataFrame itself is lazy and immutable)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _emb(i: int):
    return F.get(F.col("embedding"), i).cast("double")


def points_emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), _emb(0).alias("x"), _emb(1).alias("y")
    )


def points_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("double").alias("x"),
        F.round(F.col("p_retailprice") * 10).alias("y"),
    )


def points_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Whole minutes since 2024-01-01 00:00 from the fields of the
    # TIMESTAMP_NTZ value: independent of the session time zone, and a floor
    # (not a truncation) before that date, as in the SQL view.
    ts = F.col("ts")
    minutes = (
        F.datediff(ts.cast("date"), F.lit("2024-01-01").cast("date")).cast("long") * 1440
        + F.hour(ts) * 60
        + F.minute(ts)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        minutes.cast("double").alias("x"),
        F.round(F.col("value") * 100).alias("y"),
    )


def points_ord(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("double").alias("x"),
        F.col("o_totalprice").alias("y"),
    )


def points_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as a large point set (no unique key: id-free)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("x"),
        F.round(F.col("l_extendedprice") * 100).alias("y"),
    )


def boxes_emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        _emb(0).alias("x1"), _emb(1).alias("y1"), _emb(2).alias("x2"), _emb(3).alias("y2"),
    )


def boxes_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    left = (k * 37) % 43200
    s = F.col("p_size") * 400
    return table(spark, sf_dir, "part").select(
        k.alias("id"),
        left.cast("double").alias("x1"),
        s.cast("double").alias("y1"),
        (left + 120 + (k % 5) * 60).cast("double").alias("x2"),
        (s - 300 - (k % 3) * 400).cast("double").alias("y2"),
    )


def probes_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points_ev(spark, sf_dir)
    return p.select(
        "id",
        F.col("x").alias("x1"),
        F.col("y").alias("y1"),
        (F.col("x") + ((F.col("id") % 4) * 20).cast("double")).alias("x2"),
        (F.col("y") - ((F.col("id") % 3) * 50).cast("double")).alias("y2"),
    )


# DuckDB forms of the same views, for oracle SQL.  DuckDB arrays start at 1.
SQL_VIEWS = {
    "points_emb": "select vec_id id, embedding[1]::double x, embedding[2]::double y from embeddings",
    "points_part": "select p_partkey id, p_size::double x, round(p_retailprice*10) y from part",
    "points_ev": "select event_id id, floor((epoch(ts)-1704067200)/60) x, round(value*100) y from events",
    "points_ord": "select o_orderkey id, o_custkey::double x, o_totalprice y from orders",
    "points_line": "select l_quantity x, round(l_extendedprice*100) y from lineitem",
    "boxes_emb": (
        "select vec_id id, embedding[1]::double x1, embedding[2]::double y1, "
        "embedding[3]::double x2, embedding[4]::double y2 from embeddings"
    ),
    "boxes_part": (
        "select p_partkey id, ((p_partkey*37)%43200)::double x1, (p_size*400)::double y1, "
        "((p_partkey*37)%43200+120+(p_partkey%5)*60)::double x2, "
        "(p_size*400-300-(p_partkey%3)*400)::double y2 from part"
    ),
    "probes_ev": (
        "select id, x x1, y y1, x+((id%4)*20)::double x2, y-((id%3)*50)::double y2 from points_ev"
    ),
}

_DEPENDS = {"probes_ev": ["points_ev"]}


def with_views(*names: str) -> str:
    """A ``WITH`` prefix defining the named views (and what they read)."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    return "with " + ",\n".join(f"{n} as ({SQL_VIEWS[n]})" for n in ordered) + "\n"


VIEWS = {
    "points_emb": points_emb,
    "points_part": points_part,
    "points_ev": points_ev,
    "points_ord": points_ord,
    "points_line": points_line,
    "boxes_emb": boxes_emb,
    "boxes_part": boxes_part,
    "probes_ev": probes_ev,
}
