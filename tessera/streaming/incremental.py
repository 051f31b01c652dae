"""Incremental processing: new files through Structured Streaming into batch folders, read as one current state.

Each micro-batch replaces its own folder (``batch_id=n``), so a batch that is run again after a failure leaves one copy. The
current state is the upsert over all batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.submission import filings_table, parse_submissions
from tessera.operators.upsert import upsert_latest
from tessera.sources.readers import _relpath


def _session(spark: SparkSession, tasks: int) -> SparkSession:
    """A session for streams of many small files, with the other settings of ``spark``.

    In a batch of a few hundred small files nearly all time goes into what is done once a task or a batch. Left alone, Spark lists such a
    batch by a task for each file and reads and writes it by one for every few (a file opened counts as 4 MB). Here at most ``tasks`` list it,
    and it is dealt out to them by bytes, with more tasks where it is large. The batch's time stands as a constant in the expressions, which would be compiled
    anew for each batch, on each executor, so they are interpreted (the parsing is Python's). The whole log of files seen is
    rewritten every hundredth batch instead of every tenth. Batch folders, which hold the bodies too, are written with zstd.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in {
        "sources.parallelPartitionDiscovery.parallelism": tasks, "files.minPartitionNum": tasks, "files.openCostInBytes": 64 << 10,
        "codegen.wholeStage": "false", "codegen.factoryMode": "NO_CODEGEN", "streaming.fileSource.log.compactInterval": 100, "parquet.compression.codec": "zstd",
    }.items():
        own.conf.set(f"spark.sql.{key}", str(value))
    return own


def _sink(out: str, work: Callable[[DataFrame], DataFrame], name: str) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_id: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch_id={name}{batch_id}")

    return run


def stream_table(source: DataFrame, out: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] = lambda b: b, name: str = "") -> StreamingQuery:
    """Everything there is of a streaming DataFrame, through ``work``, into batch folders; returns the started query.

    Streams that share ``out`` need a ``name`` each. What can be said of ``source`` itself is better said there: ``work`` is analysed anew for each batch.
    """
    return source.writeStream.foreachBatch(_sink(out, work, name)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_submissions(spark: SparkSession, root: str, out: str, checkpoint: str, files_per_batch: int = 1000, name: str = "", tasks: int = 0) -> StreamingQuery:
    """New submissions below ``root`` parsed into filings; files already seen are not read again.

    A stream takes its batches one after another. Folders that have a stream each (with a ``name``, a checkpoint and some ``tasks`` of
    the cores; all cores if not said) are taken in at once. The query belongs to a session of its own.
    """
    files = (
        _session(spark, tasks or spark.sparkContext.defaultParallelism).readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").option("maxFilesPerTrigger", files_per_batch).load(root)
    )
    parsed = parse_submissions(files.select(_relpath(F.col("path"), root).alias("relpath"), "content"))
    return stream_table(filings_table(parsed).withColumn("processed_at_utc", F.current_timestamp()), out, checkpoint, name=name)


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for all to end; if one fails, the others are stopped and its error is raised."""
    try:
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            q.stop()


def current_state(spark: SparkSession, out: str, key: str = "source_relpath", order: str = "processed_at_utc", durable: str = "filing_id") -> DataFrame:
    """The latest row of each key over all batches."""
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*").drop("batch_id")
    return upsert_latest(rows.drop("record") if "record" in rows.columns else rows, key, order, durable)


def late_counts(events: DataFrame, time: str, window: str, lateness: str, *keys: str) -> DataFrame:
    """Counts per event-time window with a watermark: rows later than ``lateness`` no longer change a closed window."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n"))
