"""Session settings and shared working folders."""

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

import newsflow

# What the jobs assume. Partition counts are left to adaptive execution on a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and timing runs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("newsflow")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@cache
def _package_archive() -> str:
    root = Path(newsflow.__file__).parent
    path = Path(tempfile.mkdtemp(prefix="newsflow-")) / "newsflow.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    return str(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    The page parser and the archive reader run in Python workers, which must be able to
    import it. Not needed where the package is installed on all nodes.
    """
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        spark.sparkContext.addPyFile(_package_archive())
        _SHIPPED.add(application)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="newsflow-")


def working_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting only a local session may go on: it gets a temporary folder,
    which the executors of a cluster could not see.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/newsflow/{name}-{uuid.uuid4().hex}"
