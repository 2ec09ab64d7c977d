"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of the batches that Python tasks get; Spark's own limit is 64 MB, which each task holds several times.
BATCH_BYTES, _BATCH = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "assetlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the engine expects; cluster settings are left as they are."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        b = b.config(key, value)
    spark = b.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package; done once per Spark application."""
    sc = spark.sparkContext
    package = Path(__file__).resolve().parent
    if getattr(sc, "_assetlake_shipped", False) or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="assetlake-src-")) / "assetlake.zip"
    with zipfile.ZipFile(archive, "w") as zf:
        for file in sorted(package.rglob("*.py")):
            zf.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._assetlake_shipped = True


def prepare(spark: SparkSession) -> None:
    """Give the Python workers this package, and batches of bounded size unless a smaller size is set."""
    ship_package(spark)
    size = spark.conf.get(_BATCH)
    if not size.rstrip("b").isdigit() or not 0 < int(size.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="assetlake-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared one and read it back: its size is known then."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Freeze ``df`` in reliable storage, so that a lost executor cannot change its rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
