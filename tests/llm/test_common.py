from planar.llm import common as c


def test_workers_drop_what_others_keep():
    kept = {"packing": {1: 2}, "winnow": {3: 4}}
    for k in kept:
        c.keeps(k, kept[k].clear)
    c.tidy_worker("packing")
    assert kept == {"packing": {1: 2}, "winnow": {}}
    c.tidy_worker("winnow", always=True)
    assert kept == {"packing": {}, "winnow": {}} and not c._FULL
    c.tidy_worker()


def test_batches_are_bounded_only_where_the_session_names_no_size(spark):
    spark.conf.unset(c.BATCH_BYTES)
    c.prepare(spark)
    assert spark.conf.get(c.BATCH_BYTES) == c.TEXT_BATCH
    spark.conf.set(c.BATCH_BYTES, "5m")
    c.prepare(spark)
    assert spark.conf.get(c.BATCH_BYTES) == "5m"
    spark.conf.unset(c.BATCH_BYTES)


def test_counted_filter(spark):
    h = spark.range(5000).selectExpr("xxhash64(id) as h")
    few = c.counted_filter(h, "h")
    assert few.bits == 18 and c.counted_filter(h, "h", most=17).bits == 17 and c.counted_filter(h, "h", most=15) is None
    rows = spark.range(20000).selectExpr("id", "xxhash64(id) as h").where(few.column(c.F.col("h")))
    got = {r.id for r in rows.collect()}
    assert set(range(5000)) <= got and len(got) < 6000
