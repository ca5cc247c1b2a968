import os
import random

from planar.operators.joins import heat_map
from planar.streaming import heat_map_stream
from tests.conftest import boxes_df, points_df


def test_heat_map_over_a_stream(spark, scratch):
    rnd = random.Random(2)
    boxes = [(rnd.uniform(0, 90), rnd.uniform(0, 90), rnd.uniform(0, 90), rnd.uniform(0, 90)) for _ in range(40)]
    pts = [(rnd.uniform(0, 100), rnd.uniform(0, 100)) for _ in range(900)]
    src = os.path.join(scratch, "points")
    for k in range(3):  # three files arrive
        points_df(spark, pts[k * 300:(k + 1) * 300]).write.mode("append").parquet(src)
    stream = spark.readStream.schema("x double, y double").option("maxFilesPerTrigger", 1).parquet(src)
    b = boxes_df(spark, boxes)
    q = (
        heat_map_stream(b, stream)
        .writeStream.outputMode("complete").format("memory").queryName("heat_stream_test")
        .option("checkpointLocation", os.path.join(scratch, "ckpt"))
        .start()
    )
    try:
        q.processAllAvailable()
        got = {(r.id, r.n) for r in spark.sql("select * from heat_stream_test").collect()}
    finally:
        q.stop()
    want = {(r.id, r.n) for r in heat_map(b, points_df(spark, pts)).collect() if r.n > 0}
    assert got == want
