"""Sessions, and the folder in which intermediate tables are kept."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that the library's results rely on, or that its plans are made for.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(app: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; conf has more, with _ for each dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (spark.checkpoint.dir).

    Only a local session may go without the setting; it gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tabloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Folders of intermediate tables that this process has written, by application.
_WRITTEN: dict[str, list[str]] = {}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts its lineage and keeps
    what follows from computing it twice. Survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(spark: SparkSession) -> int:
    """Delete all intermediate tables of this session, once no result that was made from
    them is read any more; returns how many."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete(spark, path)
    return len(paths)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever they run; once for a context."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if getattr(sc, "_tabloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tabloom-")) / "tabloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._tabloom_shipped = True


#: Bytes of an Arrow batch that goes to a Python worker, about.
BATCH_BYTES, DEFAULT_BYTES = 16 << 20, "67108864b"


def bounded_batches(spark: SparkSession) -> None:
    """Make ready for Python workers: they get this package, and batches bounded by bytes, so
    that long texts and wide cells come in small ones; a session's own setting stays."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == DEFAULT_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
