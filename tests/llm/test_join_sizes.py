"""Joins whose side is exploded: the optimizer sizes it like the table it comes
from, so neither side may be left to a broadcast."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.llm import quality, simhash
from recprep.llm.common import staged


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_probes_of_fingerprints_are_not_broadcast(spark):
    fps = staged(spark.range(500).select(F.xxhash64("id").alias("fp")).union(
        spark.createDataFrame([(1,), (2,), (7,), (None,)], "fp long")), "fps")
    pairs = simhash.near_fingerprints(fps, "fp", 2)
    assert "Broadcast" not in plan(pairs)
    assert {(r.a, r.b) for r in pairs.collect()} == {(1, 2), (1, 7), (2, 7)}
    assert "BroadcastHashJoin" not in plan(pairs)


def test_questions_of_blocks_are_not_broadcast(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType())])
    blocks = staged(spark.createDataFrame([(1, b"x", [1], [("en", [5, 6])])],
                                          "block long, blob binary, ids array<long>, "
                                          "asks array<struct<lang string, keys array<long>>>"), "blocks")
    model = staged(spark.createDataFrame([("en", 5, 0.5, 0.5)], "lang string, key long, part double, weight double"),
                   "model")
    assert "Broadcast" not in plan(quality._score(blocks, model, schema, "text", "lang", ["doc_id"]))
