"""The incremental load as a stream: every micro-batch is a delta to merge, exactly once.

A batch is known by its stream and number. The version it makes bears both as a mark in its folder's name and so is
committed together with it; a ledger keeps the marks of versions that have been removed. A batch found there
is skipped. Streams are told apart by the id of their checkpoint, so a new one never takes the batches of
an older for its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.contract import Contract
from tidemark.operators.merge import MergeRules, audit_stamp, memory_bytes, merge
from tidemark.operators.quality import RAW_ROW, REASON, accepted, classify, dedupe_latest
from tidemark.sources.manifest import ManifestTable
from tidemark.sources.storage import SharedFiles, VersionedTable

REJECTED = "rejected"
UNNAMED = "unnamed"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
                bytes_per_batch: int | None = None) -> DataFrame:
    """New files under ``path`` as they arrive, so many files or bytes to a batch."""
    if files_per_batch and bytes_per_batch:
        raise ValueError("a batch is bounded by files or by bytes")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", str(bytes_per_batch))
    return reader.parquet(path)


def merge_batch(
    batch: DataFrame,
    table: VersionedTable | ManifestTable,
    contract: Contract,
    session_start: str,
    delta_column: str | None = None,
    number: int | None = None,
    stream: str = UNNAMED,
) -> bool:
    """Merge one delta into the table, once: False if this batch of the stream has been merged before.

    A batch without a number is merged whenever it comes. The batch is landed under its stream and number
    first, converted and classified, so its source is read once and a replay lands the same rows again. Its rejected rows stay
    there (see ``stream_rejects``), the accepted ones go once they are merged.
    Keys the batch lacks are left alone, and so are rows that are newer than the
    batch's by ``delta_column``. Only the slices the batch touches are read and rewritten;
    an unsliced table is rewritten whole by every batch.
    """
    spark, files = batch.sparkSession, SharedFiles(batch.sparkSession, table.path)
    landed = f"{_landing(table)}/stream={stream}/batch={_next(files, table, stream) if number is None else number}"
    mark = None if number is None else _mark(stream, number)
    entry = f"{table.path}_ledger/{mark}"
    if mark and (files.exists(f"{entry}/_SUCCESS") or table.has_mark(mark)):
        files.remove(f"{landed}/{REJECTED}=0")
        return False
    classified = classify(contract.project(batch), contract)
    classified.withColumn(REJECTED, F.col(REASON).isNotNull().cast("int")).write.mode("overwrite").partitionBy(REJECTED).parquet(landed)
    if files.exists(f"{landed}/{REJECTED}=0"):
        order: list[Column] = [F.col(delta_column).desc_nulls_last()] if delta_column else []
        diff = accepted(spark.read.schema(classified.schema).parquet(f"{landed}/{REJECTED}=0"))
        diff = audit_stamp(dedupe_latest(diff, contract.keys, order), session_start)
        slices = table.slices_of(diff)
        current = table.read(slices)
        rules = MergeRules(not_matched_by_source="ignore")
        size = None if getattr(table, "bucket_by", None) else memory_bytes(diff)
        table.write(merge(
            current, diff, contract.keys, merge_ts=session_start, rules=rules, keys_not_null=True,
            source_bytes=size, newer_by=delta_column), replaces=slices, mark=mark)
    # Outlasts the version; until it is there, the version itself says that the batch is merged.
    if mark:
        spark.range(0, 1, 1, 1).select(F.lit(stream).alias("stream"), F.lit(number).cast("bigint").alias("batch")).write.mode("overwrite").parquet(entry)
    files.remove(f"{landed}/{REJECTED}=0")
    return True


def ledger(spark: SparkSession, table: VersionedTable | ManifestTable) -> DataFrame:
    """(stream, batch) of every batch merged into the table."""
    root, files = f"{table.path}_ledger", SharedFiles(spark, table.path)
    entries = [f"{root}/{n}" for n in files.names(root) if files.exists(f"{root}/{n}/_SUCCESS")]
    schema = "stream string, batch bigint"
    return spark.read.schema(schema).parquet(*entries) if entries else spark.createDataFrame([], schema)


def stream_rejects(spark: SparkSession, table: VersionedTable | ManifestTable) -> DataFrame:
    """The rows that the batches merged into the table set aside: stream, batch, reason, the row as JSON."""
    root, files = _landing(table), SharedFiles(spark, table.path)
    schema = f"{REASON} string, {RAW_ROW} string, stream string, batch long"
    batches = [f"{root}/{s}/{b}" for s in files.names(root) for b in files.names(f"{root}/{s}")]
    folders = [f"{b}/{REJECTED}=1" for b in batches if files.exists(f"{b}/{REJECTED}=1")]
    if not folders:
        return spark.createDataFrame([], schema).select("stream", "batch", REASON, RAW_ROW)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select("stream", "batch", REASON, RAW_ROW)


def _landing(table: VersionedTable | ManifestTable) -> str:
    return f"{table.path}_batches"


def _next(files: SharedFiles, table: VersionedTable | ManifestTable, stream: str) -> int:
    """A number that no landed batch of the stream has."""
    taken = [int(n.split("=")[1]) for n in files.names(f"{_landing(table)}/stream={stream}")]
    return max(taken, default=-1) + 1


def _mark(stream: str, number: int) -> str:
    return md5(f"{stream}:{number}".encode()).hexdigest()[:16]


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream's checkpoint was given when it was made."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return "".join(ch if ch.isalnum() else "-" for ch in json.loads(row[0])["id"])


def start_merge_stream(
    stream: DataFrame,
    table: VersionedTable | ManifestTable,
    contract: Contract,
    checkpoint: str,
    session_start: str | Callable[[int], str],
    delta_column: str | None = None,
    every: str | None = None,
    keep_versions: int | None = None,
) -> StreamingQuery:
    """Merge what has arrived and stop, or keep merging ``every`` interval.

    The stream's checkpoint is the mark. ``session_start`` may be a function of the
    batch number, for streams that run on. Old versions are removed only if
    ``keep_versions`` says how many to leave.
    """
    def on_batch(batch: DataFrame, number: int) -> None:
        stamp = session_start(number) if callable(session_start) else session_start
        merge_batch(batch, table, contract, stamp, delta_column, number, _stream_id(batch.sparkSession, checkpoint))
        if keep_versions:
            table.expire(keep_versions)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
