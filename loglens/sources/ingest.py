"""Log ingestion: directory of ``*.log`` files or a Kafka topic → typed log table.

Batch and streaming share the same column expressions.  Lines that fail to
parse, or whose timestamp text is not ``yyyy-MM-dd HH:mm:ss``, are kept in a
quarantine table instead of being dropped.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import TS_FORMAT
from ..functions.parse import basename, event_time, line_time, parse_lines
from ..schemas import LOGS
from ..session import checkpointed

#: Times in JSON records are written and read in this form.
JSON_TIME = {"timestampNTZFormat": TS_FORMAT}


def read_log_files(spark: SparkSession, directory: str, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the ``*.log`` files directly under ``directory`` (no recursion).

    ``value`` is the line; ``source_file`` the file's base name.  In streaming
    mode each file is read once; the source's checkpoint records seen files.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("pathGlobFilter", "*.log").option("recursiveFileLookup", "false")
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(directory)
    return df.select("value", basename(F.col("_metadata.file_path")).alias("source_file"))


def parse_log_frame(lines: DataFrame, collected_at=None) -> DataFrame:
    """Parse a frame of ``value``/``source_file`` lines into LOGS rows plus ``event_ts``/``dt``.

    ``collected_at`` is the ingest time; by default the current timestamp.
    """
    ca = collected_at if collected_at is not None else F.date_trunc("second", F.localtimestamp())
    base = lines.withColumn("collected_at", ca.cast("timestamp_ntz"))
    p = parse_lines(base, "value", keep=["source_file", "collected_at"])
    return (p.withColumn("event_ts", line_time(F.col("raw_log")))
             .withColumn("dt", F.to_date("collected_at")))


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with a ``reason``)."""
    good = parsed.where(F.col("event_ts").isNotNull())
    bad = (parsed.where(F.col("event_ts").isNull())
                 .withColumn("reason", F.when(F.col("parse_error").isNotNull(), "parse_error")
                                        .otherwise("bad_timestamp")))
    return good, bad


def kafka_log_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                     max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Decoded JSON log records from a Kafka topic (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return decode_log_json(r.load())


def decode_log_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON value bytes → LOGS columns + ``event_ts``/``dt``."""
    rec = F.from_json(F.col(value_col).cast("string"), LOGS, JSON_TIME)
    return (df.select(rec.alias("r")).select("r.*")
              .withColumn("event_ts", event_time(F.col("timestamp")))
              .withColumn("dt", F.to_date("collected_at")))


def encode_log_json(df: DataFrame) -> DataFrame:
    """LOGS rows → Kafka ``value`` (compact JSON, nulls omitted, times as ``yyyy-MM-dd HH:mm:ss``)."""
    return df.select(F.to_json(F.struct(*[c for c in LOGS.fieldNames() if c in df.columns]), JSON_TIME).alias("value"))


def kafka_log_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Stream LOGS rows to Kafka with acks=all and retries."""
    return (encode_log_json(df).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("kafka.acks", "all").option("kafka.retries", "3")
            .option("checkpointLocation", checkpoint).start())


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch into its own ``dt``/``batch`` partitions of ``path``.  A
    replayed batch replaces what its first run wrote, so no row is doubled.  A path
    belongs to one stream, since batch ids count per checkpoint."""
    (df.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch").parquet(path))


def write_log_tables(batch: DataFrame, logs_path: str, quarantine_path: str, batch_id: int) -> None:
    """One batch: good rows to the log table, the rest to quarantine; both by day and
    batch.  The stream's clock is fixed per batch, so a replay gives the same days."""
    batch = batch.persist()
    try:
        good, bad = split_quarantine(batch)
        write_batch(good, logs_path, batch_id)
        write_batch(bad, quarantine_path, batch_id)
    finally:
        batch.unpersist()


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before anything was written to it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def _without(closed: DataFrame, open_: DataFrame) -> DataFrame:
    """Closed rows of batches that the open table doesn't hold (any more)."""
    return closed.join(open_.select("dt", "batch").distinct(), ["dt", "batch"], "left_anti")


def compact_days(spark: SparkSession, path: str, closed_path: str, before: str) -> int:
    """Move the days before ``before`` from the table that a stream writes (a folder
    per day and batch) to one with a folder per day, as few large files.  Returns
    the number of days.  Rows keep their batch, so a run that failed between the
    copy and the deletion, or a batch that came late, can be compacted again;
    :func:`log_table` reads each row once at any moment."""
    rows = stored_rows(spark, path)
    if rows is None:
        return 0
    rows = rows.where(F.col("dt") < F.lit(before).cast("date"))
    done = [tuple(r) for r in rows.select("dt", "batch").distinct().collect()]     # one row per micro-batch
    if not done:
        return 0
    closed = stored_rows(spark, closed_path)
    if closed is not None:
        days = rows.select("dt").distinct()
        rows = _without(closed.join(F.broadcast(days), "dt", "left_semi"), rows).unionByName(rows)
    (checkpointed(rows).hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(closed_path))
    for dt, batch in done:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dt={dt}/batch={batch}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len({dt for dt, _ in done})


def log_table(spark: SparkSession, path: str, closed_path: str) -> DataFrame | None:
    """All rows of a table that is compacted by day."""
    rows, closed = stored_rows(spark, path), stored_rows(spark, closed_path)
    if rows is None or closed is None:
        return closed if rows is None else rows
    return _without(closed, rows).unionByName(rows)


def create_log_table(spark: SparkSession, name: str, location: str) -> None:
    """CREATE TABLE IF NOT EXISTS for the typed log table, partitioned by day."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LOGS.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, event_ts timestamp_ntz, dt date) "
              f"USING parquet PARTITIONED BY (dt) LOCATION '{location}'")
