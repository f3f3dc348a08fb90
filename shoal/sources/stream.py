"""Stream sources.

The raw source is data, not code: ``SourceOptions.format`` picks Kafka in production
and a file source (``text``) in tests; every ``kafka.``-prefixed client setting is
passed through untouched.  The output is always one ``value STRING`` column.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SourceOptions:
    format: str = "kafka"  # "kafka" or a file format ("text", "json" as text lines)
    topic: str | None = None  # Kafka: subscribe
    path: str | None = None  # file sources: directory to watch
    starting_offsets: str | None = None  # "earliest" | "latest" | JSON offsets
    max_offsets_per_trigger: int | None = None
    min_offsets_per_trigger: int | None = None
    max_trigger_delay: str | None = None  # e.g. "15m"
    max_files_per_trigger: int | None = None  # file sources
    fail_on_data_loss: bool = False  # carry on when offsets expired / files vanished
    options: Mapping[str, str] = field(default_factory=dict)  # pass-through
    schema: str | None = None  # file sources: fixed schema (incl. partition columns)


def kafka_options(o: SourceOptions) -> dict[str, str]:
    """Option map for ``readStream.format("kafka")``."""
    if not o.topic:
        raise ValueError("a Kafka source needs a topic")
    opts = {"subscribe": o.topic, "failOnDataLoss": str(o.fail_on_data_loss).lower(),
            "startingOffsetsByTimestampStrategy": "latest"}
    if o.starting_offsets is not None:
        opts["startingOffsets"] = o.starting_offsets
    if o.max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(o.max_offsets_per_trigger)
    if o.min_offsets_per_trigger is not None:
        opts["minOffsetsPerTrigger"] = str(o.min_offsets_per_trigger)
    if o.max_trigger_delay is not None:
        opts["maxTriggerDelay"] = o.max_trigger_delay
    opts.update({k: str(v) for k, v in o.options.items()})
    return opts


def file_options(o: SourceOptions) -> dict[str, str]:
    opts: dict[str, str] = {}
    if o.max_files_per_trigger is not None:
        opts["maxFilesPerTrigger"] = str(o.max_files_per_trigger)
    if not o.fail_on_data_loss:
        opts["ignoreMissingFiles"] = "true"
    opts.update({k: str(v) for k, v in o.options.items()})
    return opts


def read_stream(spark: SparkSession, o: SourceOptions) -> DataFrame:
    """The raw stream (``value STRING``, plus partition columns of a file
    source whose ``schema`` names them)."""
    if o.format == "kafka":
        reader = spark.readStream.format("kafka").options(**kafka_options(o))
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if not o.path:
        raise ValueError(f"a {o.format} source needs a path")
    reader = spark.readStream.format("text").options(**file_options(o))
    if o.schema:
        # fixed up front: a directory that is still empty must not freeze the schema
        # without the partition columns that later files bring
        reader = reader.schema(o.schema)
    return reader.load(o.path)


def read_file_names(spark: SparkSession, o: SourceOptions) -> DataFrame:
    """The files of a directory as a stream of their names (``path``), not opened: a batch
    is a list of files, which its reader may take apart.  In a directory a stream writes,
    its log decides what counts."""
    schema = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
    reader = spark.readStream.format("binaryFile").options(**file_options(o)).schema(f"{schema}, {o.schema}" if o.schema else schema)
    return reader.load(o.path).select("path")


def read_raw_batch(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """S3/S6 in batch form: committed stage-1 text (the sink log decides what counts),
    optionally only files modified after a time stamp."""
    reader = spark.read.option("ignoreMissingFiles", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.text(path).select("value")


def newest_file(spark: SparkSession, path: str) -> str:
    """``path``, or the newest file in it if it is a folder (equal times: the last name)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.getFileStatus(p).isDirectory():
        return path
    files = [(s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(p)
             if s.isFile() and s.getPath().getName()[0] not in "._"]
    if not files:
        raise FileNotFoundError(f"no file in {path}")
    return max(files)[1]


def read_allow_list(spark: SparkSession, path: str) -> DataFrame:
    """Names in the first row of a CSV file, one per output row (``name``).

    Only the first line is read, so the result is bounded by one line of text; the
    caller decides whether it is small enough to inline (see ``allow_list_filter``).
    """
    first = spark.read.csv(path).limit(1)
    return first.select(F.explode(F.array(*[F.trim(F.col(c)) for c in first.columns])).alias("name")).filter(
        F.col("name").isNotNull() & (F.col("name") != "")
    )
