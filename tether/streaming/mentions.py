"""Records as they arrive: mentions of each archive dropped into a folder.

Getting from a record to its mentions needs no other record, so the batch functions run on a stream as they are, without state or
watermark. Lemmas, learned tags and typed entities join tables: with them each batch of records is a small batch job of its own
(``write_mention_batches``). Linking records as they arrive is in ``tether.streaming.linking``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tether.plans.documents import document_mentions
from tether.session import stored
from tether.sources import archive


def record_stream(spark: SparkSession, folder: str, line_end: str = "\r\n", max_files: int | None = None) -> DataFrame:
    """Streaming ``(warc_id, body)`` of the archives in ``folder``; ``max_files`` bounds the files of one micro-batch."""
    reader = spark.readStream.option("lineSep", archive.line_separator(line_end))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    records = reader.text(folder).select(F.explode_outer(archive.record_texts(F.col("value"))).alias("record")).where("record <> ''")
    return archive.documents(archive.read_records(records))


def mention_stream(spark: SparkSession, folder: str, line_end: str = "\r\n", max_files: int | None = None) -> DataFrame:
    """Streaming ``(warc_id, mentions)`` of the archives in ``folder``, by the capitalisation rule."""
    return document_mentions(record_stream(spark, folder, line_end, max_files))


def write_mentions(mentions: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append the stream to a Parquet table; each file is taken once, also after a restart from the same ``checkpoint``."""
    writer = mentions.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def in_batches(records: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Give each batch of a record stream to ``work``, stored, with its number. A batch that was cut short comes again with the same rows."""

    def run(batch: DataFrame, number: int) -> None:
        docs = stored(batch, "records")
        if not docs.isEmpty():
            work(docs, number)

    writer = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_mention_batches(records: DataFrame, path: str, checkpoint: str, available_now: bool = False, **mention_options) -> StreamingQuery:
    """Write ``document_mentions`` of a record stream, with any of its options, to ``path/batch=<number>``; a repeated batch writes the same again."""

    def work(docs: DataFrame, number: int) -> None:
        document_mentions(docs, **mention_options).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return in_batches(records, work, checkpoint, available_now)
