"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # country/region/city style directory names are text, never numbers or dates
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}
LOCAL_SETTINGS = {"spark.ui.enabled": "false"}


def build_session(master: str | None = None, app: str = "millrace", **settings: str) -> SparkSession:
    """Session with the settings the operators expect; keyword settings use ``__`` for dots.

    Without a master, the one ``spark-submit`` was given applies.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = LOCAL_SETTINGS if master and master.startswith("local") else {}
    overrides = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SESSION_SETTINGS, **local, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, name: str) -> str | None:
    """A setting of the session, or of the application it runs in; None where unset."""
    return spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def shared_folder(spark: SparkSession) -> str:
    """Folder of this application that every executor can reach.

    On a cluster it lies under ``spark.checkpoint.dir``. A machine-local folder is used only by a
    local master, where driver and executors share one disk.
    """
    base = setting(spark, CHECKPOINT_SETTING)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/millrace-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier call has returned."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a recomputation, and values that
    depend on the physical layout (such as a partition number) are fixed once.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _STAGED[staged] = path
    return staged


#: Paths of staged tables, as long as the frames that ``stage`` returned are in use.
_STAGED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def release(*staged: DataFrame) -> None:
    """Delete tables that ``stage`` made and nothing will read again: all that was made of them is written itself."""
    for df in staged:
        path = _STAGED.pop(df, None)
        if path:
            context = df.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
