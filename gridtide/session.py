"""Session settings and the reliable materialisation the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "gridtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Work per row is heavy here; let small shuffles keep more than one task.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # GB18030, GBK and Big5 input files need the full set of JVM charsets.
        "spark.sql.legacy.javaCharsets": "true",
        "spark.ui.enabled": "false",
        # Checkpoints go when nothing refers to them any more; `drop_scratch` removes stored tables.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")
        folder = tempfile.mkdtemp(prefix="gridtide-checkpoint-")
    context.setCheckpointDir(folder)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute `df` once into the shared checkpoint folder and cut its lineage.

    Used where two reads of a plan must agree, or where a small table decides the plan.
    The copy is replicated storage, so it survives the loss of executors.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Like `materialise`, as Parquet in the same folder: read by column, and of a size that the optimizer knows."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_scratch(spark: SparkSession) -> None:
    """Remove everything that this session wrote below the checkpoint folder, at the end of a run.

    Frames that read stored or checkpointed tables cannot be used afterwards.
    """
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    if folder.isDefined():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder.get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
