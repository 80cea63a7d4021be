"""The job: one source of observations, two result streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.clock import now_epoch
from tidemark.plans.product import OBSERVATION_SPEC, prepare, result_document
from tidemark.plans.shop import RUN_KEY, run_input
from tidemark.schema import OBSERVATION_SCHEMA
from tidemark.sources.observations import read_observations
from tidemark.sources.quality import RUN_TIMES, split_valid
from tidemark.sources.results import encode_product, encode_run, write_updates
from tidemark.streaming.updates import product_updates, run_updates

# What one trigger reads unless the source options say otherwise. It bounds the
# rows of a key that a task sorts, so a job always has a limit.
LIMITS = {
    "kafka": {"maxOffsetsPerTrigger": "1000000"},
    "json": {"maxFilesPerTrigger": "200"},
    "parquet": {"maxFilesPerTrigger": "200"},
}


@dataclass(frozen=True)
class JobConfig:
    """Where the job reads and writes. Broker addresses and topics come from
    the deployment; there are no built-in ones."""

    source: str
    source_format: str
    product_target: str
    run_target: str
    sink_format: str
    rejects_target: str | None = None
    checkpoint_root: str | None = None
    source_options: dict[str, str] = field(default_factory=dict)
    sink_options: dict[str, str] = field(default_factory=dict)
    name: str = "observations"
    interval: str | None = "30 seconds"
    parallelism: int | None = None
    state_ttl: int | None = None
    clock: str = "processing"
    on_reject: str = "null"
    coalesce_updates: bool = False
    keyed_messages: bool = False


def product_rows(observations: DataFrame, config: JobConfig) -> DataFrame:
    """``infos`` per changed product result; rows that cannot be used are out."""
    valid, _ = split_valid(observations)
    updates = product_updates(
        prepare(valid, OBSERVATION_SPEC.scale),
        OBSERVATION_SPEC,
        _clock(config),
        OBSERVATION_SCHEMA.fieldNames(),
        config.on_reject,
        config.coalesce_updates,
        config.state_ttl,
    )
    document = result_document(F.col("metrics"), F.col("latest"))
    return updates.select(encode_product(document).alias("infos"))


def run_rows(observations: DataFrame, config: JobConfig) -> DataFrame:
    """``shop_name, shop_agg`` after each event."""
    valid, _ = split_valid(observations, RUN_TIMES, ())
    updates = run_updates(
        run_input(valid),
        RUN_KEY,
        "date",
        "arrival",
        "count",
        config.coalesce_updates,
        config.state_ttl,
    )
    return updates.select(
        RUN_KEY, encode_run(F.col("date"), F.col("run_count")).alias("shop_agg")
    )


def reject_rows(observations: DataFrame) -> DataFrame:
    return split_valid(observations)[1]


def _named_folder(spark: SparkSession) -> str:
    """The shared folder; a job must find its state again after a restart."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not named:
        raise ValueError("a streaming job needs checkpoint_root or spark.checkpoint.dir")
    return named


def start_job(spark: SparkSession, config: JobConfig) -> list[StreamingQuery]:
    """Starts the result streams, each with its own checkpoint."""
    if config.parallelism:
        spark.conf.set("spark.sql.shuffle.partitions", str(config.parallelism))
    observations = read_observations(
        spark,
        config.source,
        config.source_format,
        streaming=True,
        options=_limited(config),
        keyed=config.keyed_messages,
    )
    root = config.checkpoint_root or f"{_named_folder(spark)}/{config.name}"
    streams = {
        "product": (product_rows(observations, config), config.product_target),
        "run": (run_rows(observations, config), config.run_target),
    }
    if config.rejects_target:
        streams["rejects"] = (reject_rows(observations), config.rejects_target)
    return [
        write_updates(
            rows,
            config.sink_format,
            target,
            f"{root}/{stream}",
            f"{config.name}-{stream}",
            config.interval,
            config.sink_options,
        )
        for stream, (rows, target) in streams.items()
    ]


def run_job(spark: SparkSession, config: JobConfig) -> None:
    """Starts the streams and waits: until all are drained with
    ``interval=None``, else until one fails, which stops the others."""
    queries = start_job(spark, config)
    try:
        if config.interval is None:
            for query in queries:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def _limited(config: JobConfig) -> dict[str, str]:
    if any(name.endswith("PerTrigger") for name in config.source_options):
        return config.source_options
    return LIMITS[config.source_format] | config.source_options


def _clock(config: JobConfig) -> Column:
    if config.clock == "processing":
        return now_epoch()
    if config.clock == "arrival":
        return F.col("arrival_time")
    raise ValueError("clock must be 'processing' or 'arrival'")
