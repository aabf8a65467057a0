"""Session set-up and the lineage-cutting helpers every operator shares."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app_name: str = "recprep",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build one tuned for this library.

    On a cluster the launcher's settings win: ``getOrCreate`` only applies
    options when no session exists yet.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory from the session; a private one only in local mode.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    is always used when present. Only a ``local`` master with nothing set gets
    a fresh temporary folder (tests, laptops).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) so checkpoints survive executor loss")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="recprep-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint: cuts lineage and freezes nondeterministic
    layout (range bounds, partition ids) in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``recprep`` importable in Python workers (``--py-files`` done
    from code): the package is zipped once per application and added with
    ``addPyFile``; Spark serves the zip from the driver to every executor.
    Needed by the parts that run Python on executors (TFRecord data source,
    Arrow-batch model functions)."""
    import zipfile

    import recprep

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(recprep.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="recprep-pyfiles-"), "recprep.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(root):
            for f in names:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint directory for intermediate tables
    (for example files written to exercise a reader)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "staging", f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def shuffles_end_with_writes(spark: SparkSession):
    """Inside, the shuffle files of a write (or of a result that is collected)
    go as soon as it has ended, and not when the driver happens to collect its
    garbage. Spark 4.1 and later; earlier versions ignore the setting."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as compressed Parquet in the shared folder and read it
    back: cuts the lineage like a checkpoint, but later scans read only the
    columns they need."""
    path = staging_path(df.sparkSession, name)
    with shuffles_end_with_writes(df.sparkSession):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
