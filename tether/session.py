"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "tether", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; on a cluster use the session spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session's ``spark.checkpoint.dir`` names it, or else one in the warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    return path.rstrip("/") if path else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tether"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier call has returned."""
    return f"{shared_dir(spark)}/tether-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the stored table.

    Cuts lineage (a lost executor costs a re-read, not a recompute) and lets several consumers read only their own columns.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df``, read straight from files, by ``key`` over all cores if it has fewer partitions than there are cores.

    For few or badly split input files before costly row work. Inputs that already keep every core busy are left alone, so no large
    table is shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
