"""Links of records as they arrive.

The links of a record depend on its own mentions and on the knowledge base, not on other records, so records can be linked batch by batch.
What batches have in common is the search: a mention is searched when it first appears, and its candidates are kept in a table that all
later batches read. Everything a batch writes is in folders that carry its number and is written whole, and a batch reads only what
batches before it have written. So a batch that comes again after a failure writes the same again, and nothing twice.

Under ``path``: ``searched/batch=n`` the mentions that batch n met first, ``candidates/batch=n`` their candidates, ``links/batch=n`` its links.
The knowledge base is that of the time of the search: after a change of labels start with a new path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tether.operators import search
from tether.operators.mentions import mention_counts
from tether.operators.rows import keyed
from tether.plans.documents import record_mentions
from tether.plans.linking import LINK_OPTIONS, links_of, occurrences
from tether.session import stored
from tether.streaming.mentions import in_batches, record_stream

SEARCHED = "mention string, batch long"
CANDIDATES = "mention string, kb_id string, labels array<string>, search_score double, batch long"
LINKS = "warc_id string, mention string, kb_id string, batch long"


def _before(spark: SparkSession, path: str, schema: str, number: int) -> DataFrame:
    """What batches before ``number`` have written to ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col("batch") < number)


def link_batch(docs: DataFrame, number: int, labels: DataFrame, triples: DataFrame, path: str, size: int = 100, results: int = 10, **options) -> None:
    """Link one batch of records ``(warc_id, body)``; ``options`` are those of ``best_links``."""
    spark = docs.sparkSession
    mention_options = {k: v for k, v in options.items() if k not in LINK_OPTIONS}
    counts = stored(mention_counts(record_mentions(keyed(docs), **mention_options)), "mentions")
    names = counts.select("mention").distinct()
    new = names.join(_before(spark, f"{path}/searched", SEARCHED, number), "mention", "left_anti")
    new.write.mode("overwrite").parquet(f"{path}/searched/batch={number}")
    new = spark.read.schema("mention string").parquet(f"{path}/searched/batch={number}")
    found = search.best_candidates(new, labels, size, results)
    found.write.mode("overwrite").parquet(f"{path}/candidates/batch={number}")
    known = _before(spark, f"{path}/candidates", CANDIDATES, number + 1).drop("batch")
    links = links_of(counts, triples=triples, candidates=known.join(names, "mention", "left_semi"), **options)
    occurrences(links).write.mode("overwrite").parquet(f"{path}/links/batch={number}")


def link_stream(
    spark: SparkSession,
    folder: str,
    labels: DataFrame,
    triples: DataFrame,
    path: str,
    checkpoint: str,
    line_end: str = "\r\n",
    max_files: int | None = None,
    available_now: bool = False,
    **options,
) -> StreamingQuery:
    """Link the records of each archive that is put into ``folder``; see ``read_links`` for the outcome.

    ``options`` are those of ``best_links``, lemma, tag and name tables included. ``max_files`` bounds the archives of one batch.
    """
    records = record_stream(spark, folder, line_end, max_files)
    return in_batches(records, lambda docs, number: link_batch(docs, number, labels, triples, path, **options), checkpoint, available_now)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """``(warc_id, mention, kb_id)`` of all batches so far."""
    return _before(spark, f"{path}/links", LINKS, 1 << 62).select("warc_id", "mention", "kb_id")
