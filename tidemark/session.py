"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str,
    master: str | None = None,
    parallelism: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if parallelism:
        builder = builder.config("spark.sql.shuffle.partitions", str(parallelism))
    for name, value in (extra or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB with incremental (changelog) checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none (tests, a laptop) is a local one made.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = context.getCheckpointDir()
    if current is None:
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
        current = context.getCheckpointDir()
    return named or current


def stored(df: DataFrame) -> DataFrame:
    """Write a wide intermediate to the shared folder as Parquet, so that what was
    costly to make is made once and its columns are read alone."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """Write a small intermediate to the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
