"""File streams of examples and streaming metrics.

N1 iterates Parquet parts as a file-source stream instead of loading them at
once. N2 keeps the metric state as a small grouped aggregate -- positive and
negative counts plus summed log-loss per AUC threshold bucket (at most
``num_thresholds`` rows) -- updated micro-batch by micro-batch; the final
state gives AUC and mean log-loss exactly as the batch computation over the
same files. Checkpoints and sink tables live under the shared checkpoint
folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recprep.functions.scalar import logistic_loss
from recprep.operators.metrics import auc_from_buckets, threshold_bucket
from recprep.session import staging_path

STATE_SCHEMA = "bucket int, pos bigint, neg bigint, loss_sum double"
#: committed states that stay on disk
STATES_KEPT = 8


def stream_examples(spark: SparkSession, path: str, schema: StructType | str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over Parquet parts; all new files in one
    micro-batch unless ``max_files_per_trigger`` bounds them."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_to_table(stream: DataFrame, out_path: str, checkpoint: str | None = None) -> str:
    """Run a stream to the end of its input (``availableNow``) appending to
    a Parquet table; returns the table path."""
    spark = stream.sparkSession
    ck = checkpoint or staging_path(spark, "stream-ckpt")
    q = (stream.writeStream.format("parquet").option("path", out_path)
               .option("checkpointLocation", ck).outputMode("append")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def metric_state(stream: DataFrame, logit: str = "logit", label: str = "label",
                 num_thresholds: int = 200) -> DataFrame:
    """N2 state: per threshold bucket, positives, negatives, loss sum."""
    return stream.groupBy(threshold_bucket(logit, num_thresholds).alias("bucket")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label) != 1).cast("bigint")).alias("neg"),
        F.sum(logistic_loss(logit, label)).alias("loss_sum"))


def run_stream_metrics(stream: DataFrame, logit: str = "logit", label: str = "label",
                       num_thresholds: int = 200, state_path: str | None = None,
                       checkpoint: str | None = None, state_partitions: int = 4) -> str:
    """Run N2 to the end of the input; each micro-batch saves the complete
    (bounded) bucket table as a new state (``save_state``). Returns the path.

    The state has at most ``num_thresholds`` rows whatever the input size
    (the heavy part, the per-batch partial aggregation, runs over all input
    splits), so it is kept in ``state_partitions`` state-store partitions.
    Spark fixes that number when a query first starts, from the session's
    shuffle setting; it is set only around ``start()``.
    """
    spark = stream.sparkSession
    state_path = state_path or staging_path(spark, "metric-state")
    ck = checkpoint or staging_path(spark, "metric-ckpt")

    writer = (metric_state(stream, logit, label, num_thresholds).writeStream
              .outputMode("complete").foreachBatch(lambda batch, epoch: save_state(batch, epoch, state_path))
              .option("checkpointLocation", ck).trigger(availableNow=True))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    q.awaitTermination()
    return state_path


def committed_epoch(spark: SparkSession, state_path: str) -> int | None:
    """The last epoch whose state was saved whole; None if there is none."""
    folder = _hadoop_path(spark, f"{state_path}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=None)


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def save_state(state: DataFrame, epoch: int, state_path: str, keep: int = STATES_KEPT) -> None:
    """Save one epoch's state: its own folder first, then an empty commit file
    named after the epoch. Readers follow the last commit, so they see a whole
    state or the one before it, never a half-written one. An epoch that runs
    again after its commit changes nothing; one that failed before its commit
    is written anew. The last ``keep`` states stay, for readers still at work.
    """
    spark = state.sparkSession
    last = committed_epoch(spark, state_path)
    if last is not None and epoch <= last:
        return
    state.coalesce(1).write.mode("overwrite").parquet(f"{state_path}/epoch-{epoch}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    mark = _hadoop_path(spark, f"{state_path}/commits/{epoch}")
    fs = mark.getFileSystem(conf)
    fs.mkdirs(mark.getParent())
    fs.create(mark, True).close()
    # the commit file goes first: no reader is sent to a state that is being removed
    for old in sorted(int(s.getPath().getName()) for s in fs.listStatus(mark.getParent())
                      if s.getPath().getName().isdigit())[:-keep]:
        fs.delete(_hadoop_path(spark, f"{state_path}/commits/{old}"), False)
        fs.delete(_hadoop_path(spark, f"{state_path}/epoch-{old}"), True)


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The last committed state; an empty one before the first commit."""
    epoch = committed_epoch(spark, state_path)
    if epoch is None:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(f"{state_path}/epoch-{epoch}")


def metrics_from_state(spark: SparkSession, state_path: str, num_thresholds: int = 200) -> DataFrame:
    """AUC and mean log-loss from the last committed state."""
    st = read_state(spark, state_path)
    auc = auc_from_buckets(st.select("bucket", "pos", "neg"), num_thresholds)
    loss = st.agg(F.try_divide(F.sum("loss_sum"), F.sum("pos") + F.sum("neg")).alias("log_loss")).first()
    return auc.withColumn("log_loss", F.lit(loss["log_loss"]).cast("double"))
