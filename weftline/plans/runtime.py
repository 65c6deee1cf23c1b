"""Session helpers shared by all operators: table access and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, so that they need not have it installed.

    To be called before an operator, as a Python function keeps the list of files of the time it was made. Spark's own file server hands it out, to executors that join later too.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="weftline-")) / "weftline.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent a local master gets a temporary folder; any other master is an error,
    as a folder of one machine cannot serve executors on another.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="weftline-")
    spark.conf.set("spark.checkpoint.dir", path)
    _delete_on_exit(spark, path)
    return path


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, computes the plan once instead of twice, keeps columns prunable
    and survives the loss of any executor. The table is removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
