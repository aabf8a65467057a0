import math

from pyspark.sql import functions as F

from recprep import fixtures as fx
from recprep.operators.metrics import log_loss, roc_auc_thresholded
from recprep.session import staging_path
from recprep.streaming import streams
from conftest import SF_SMALL


def test_stream_metrics_equal_batch(spark):
    logits = fx.logits(spark, SF_SMALL)
    src = staging_path(spark, "logits")
    logits.repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema
    state = streams.run_stream_metrics(streams.stream_examples(spark, src, schema, 1))
    got = streams.metrics_from_state(spark, state).first()
    batch = spark.read.parquet(src)
    assert math.isclose(got["roc_auc"], roc_auc_thresholded(batch).first()[0], rel_tol=1e-12)
    assert math.isclose(got["log_loss"], log_loss(batch).first()[0], rel_tol=1e-9)


def test_stream_examples_to_table(spark):
    src = staging_path(spark, "examples")
    spark.range(0, 300).withColumn("x", F.col("id") * 2).repartition(3).write.parquet(src)
    sink = staging_path(spark, "sink")
    schema = spark.read.parquet(src).schema
    streams.stream_to_table(streams.stream_examples(spark, src, schema, 1), sink)
    assert sorted(r[0] for r in spark.read.parquet(sink).select("id").collect()) == list(range(300))
