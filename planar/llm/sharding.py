"""Shards by extendible hashing, in DataFrame operations only.

A row's key is hashed to 60 bits (the first 15 hex digits of its MD5).  The
directory starts as one bucket; a bucket whose rows exceed the byte limit is
split on the next bit, and only that one, until every bucket fits.  A shard
is named by its prefix bits, its local depth is their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planar.plans.session import ensure_checkpoint_dir

HASH_BITS = 60
STEP = 8  # bits by which a directory that turns out too coarse is refined


def key_hash(col: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(hash_: Column, depth: int) -> Column:
    """The first ``depth`` bits of a hash, as a number."""
    return F.shiftright(hash_, HASH_BITS - depth)


def _split(cells: DataFrame, top: int, depth: int, limit: int) -> DataFrame:
    """``cells (cell, bytes)`` at ``depth`` bits: per cell the depth of its
    shard, the smallest in ``top .. depth`` whose bucket fits (null: none)."""
    levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(top), F.lit(depth))).alias("d")).select(
        "cell", "bytes", "d", F.expr(f"shiftright(cell, {depth} - d)").alias("bucket")
    )
    fits = levels.groupBy("d", "bucket").agg(F.sum("bytes").alias("sum")).where(F.col("sum") <= limit).select("d", "bucket")
    return (
        levels.join(fits, ["d", "bucket"], "left_semi").groupBy("cell").agg(F.min("d").alias("d"))
        .join(cells.select("cell"), "cell", "right")
    )


def shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = 1 << 20
) -> DataFrame:
    """``(doc_id, n_bytes, shard, depth, part)``, one row per input row.

    ``shard`` is the bucket's prefix bits ('' for the whole space), ``depth``
    their number; ``n_bytes`` is the text's UTF-8 length (null: 0).  A null
    key hashes like ''.  Rows whose keys agree in all 60 bits (repeated keys)
    cannot be split on a bit: where they exceed the limit together, they form
    overflow parts of one bucket, ``part`` 0, 1, ..., each within the limit
    but for a single row that is larger itself.  Everywhere else ``part`` is
    0.  An empty table gives no rows; other columns are ignored.

    The directory is worked out on sums per hash prefix, about 16 per shard,
    never on rows; only prefixes that are still too large at that depth are
    summed again, on more bits.  Rows then join it by prefix.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
        key_hash(F.col(id_col)).alias("hash"),
    ).checkpoint()
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(HASH_BITS, max(0, (total // max(1, max_bytes)).bit_length() + 4))
    top, todo, done = 0, rows, None
    while True:
        cells = todo.groupBy(_prefix(F.col("hash"), depth).alias("cell")).agg(F.sum("n_bytes").alias("bytes"))
        plan = _split(cells, top, depth, max_bytes).checkpoint()
        placed = todo.withColumn("cell", _prefix(F.col("hash"), depth)).join(plan, "cell").drop("cell")
        if depth == HASH_BITS or plan.where("d is null").isEmpty():
            done = placed if done is None else done.unionByName(placed)
            break
        fits = placed.where("d is not null")
        done = fits if done is None else done.unionByName(fits)
        todo = placed.where("d is null").drop("d").checkpoint()
        top, depth = depth + 1, min(HASH_BITS, depth + STEP)
    settled = done.where("d is not null").select("doc_id", "n_bytes", "hash", "d", F.lit(0).cast("long").alias("part"))
    over = _overflow(done.where("d is null").drop("d"), max_bytes).withColumn("d", F.lit(HASH_BITS))
    return settled.unionByName(over).select(
        "doc_id", "n_bytes",
        F.expr(f"if(d = 0, '', lpad(conv(cast(shiftright(hash, {HASH_BITS} - d) as string), 10, 2), d, '0'))").alias("shard"),
        F.col("d").cast("int").alias("depth"), "part",
    )


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of buckets that no bit can split: a salt deals each bucket to
    lots (as many as its bytes ask for), and a running sum within a lot cuts
    it into parts, so no lot grows with the bucket."""
    spread = rows.groupBy("hash").agg(F.ceil(F.sum("n_bytes") / (8 * limit)).alias("lots"))
    lot = Window.partitionBy("hash", "lot").orderBy("n_bytes", "salt")
    running = lot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = (
        rows.join(spread, "hash").withColumn("salt", F.monotonically_increasing_id())
        .withColumn("lot", F.pmod(F.xxhash64("salt"), F.greatest(F.col("lots"), F.lit(1)))).checkpoint()
    )
    # Half the limit per step: a part ends within the limit whatever its last row.
    step = dealt.withColumn("cut", F.floor((F.sum("n_bytes").over(running) - F.col("n_bytes")) / F.lit(max(1, limit // 2))))
    big = F.col("n_bytes") > limit // 2
    named = step.withColumn("cut", F.when(big, F.concat(F.lit("r"), "salt")).otherwise(F.concat(F.lit("c"), "cut")))
    parts = (
        named.select("hash", "lot", "cut").distinct()
        .withColumn("part", F.row_number().over(Window.partitionBy("hash").orderBy("lot", "cut")).cast("long") - 1)
    )
    return named.join(parts, ["hash", "lot", "cut"]).select("doc_id", "n_bytes", "hash", "part")


def shard_sql(max_bytes: int = 1 << 20) -> str:
    return f"""
with r as (select row_number() over () rid, doc_id, coalesce(strlen(text), 0)::bigint n_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint h from documents),
l as (select rid, n_bytes, d, h >> (60 - d) b from r, (select unnest(range(0, 61)) d)),
f as (select d, b from l group by d, b having sum(n_bytes) <= {max_bytes}),
m as (select rid, min(d) d from l join f using (d, b) group by rid)
select doc_id, n_bytes, case when d = 0 then '' else lpad(bin(h >> (60 - d)), d::int, '0') end shard, d::int "depth", 0::bigint part
from r join m using (rid)
"""
