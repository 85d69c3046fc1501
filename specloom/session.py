"""One place that builds or tunes a SparkSession, and names shared scratch space."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.legacy.charVarcharAsString": "true",
}


def build_session(app: str = "specloom", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session. On a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, else one below the warehouse.

    Both are settings that each deployment has; no folder of one machine is made up here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.stages"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/specloom/{label}-{uuid.uuid4().hex}"


def store(df, label: str = "stage"):
    """Write a frame to a fresh table in the shared folder and read it back.

    Cuts lineage, keeps column pruning, and gives Spark the real size of the
    result: joins then broadcast it only below spark.sql.autoBroadcastJoinThreshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*frames) -> None:
    """Delete the tables that `store` wrote, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        top = f"{shared_dir(spark).rstrip('/')}/specloom/"
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            plain = jvm.org.apache.hadoop.fs.Path(top).toUri().getPath().rstrip("/")
            if path.toUri().getPath().startswith(plain + "/"):
                path.getFileSystem(conf).delete(path, True)


def settle(df):
    """Cut lineage with a reliable checkpoint that also keeps partitions and row order."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, whichever thread asks first.

    Executors need it wherever a pandas function refers to it, and have it already
    only if it is installed there or was submitted as a zip.
    """
    sc = spark.sparkContext
    package = Path(__file__).resolve().parent
    with _SHIPPING:  # a second archive of that name would be refused
        if sc.applicationId in _SHIPPED or not package.is_dir():
            return
        archive = Path(tempfile.mkdtemp(prefix="specloom-")) / "specloom.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, Path(package.name) / file.relative_to(package))
        sc.addPyFile(str(archive))
        _SHIPPED.add(sc.applicationId)
