"""Session and shared-storage helpers used by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("weft")
    base = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = builder.config(map={**base, **conf}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder; on a cluster a
    missing setting is an error, because a folder of one machine would be lost
    with that machine.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not known:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        known = tempfile.mkdtemp(prefix="weft-")
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder once.

    The table is read back from the shared folder, so a lost executor costs
    nothing but a re-read. Files go when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weft/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)
