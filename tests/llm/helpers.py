"""Small inputs and brute-force versions for the tests of this folder."""

from pyspark.sql import types as T

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_df(spark, texts, ids=None, lang=None, parts=3):
    rows = [
        (i if ids is None else ids[i], t, None if lang is None else lang[i], f"src{i % 2}", None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(parts) if rows else spark.createDataFrame([], DOC_SCHEMA)


def words_of(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def write_tables(spark, folder, **frames):
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def clashing(df):
    """The frame with extra columns named like internal ones."""
    from pyspark.sql import functions as F

    for c in ("fp", "root", "fingerprint", "component_id", "key", "node", "n", "mask", "pattern", "start", "length", "score", "bytes", "hash"):
        df = df.withColumn(c, F.lit("x"))
    return df


LONG = T.LongType()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
