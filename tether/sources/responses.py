"""Stored responses of search and graph services, one JSON text per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shapes of the two responses.
HITS_SCHEMA = "hits STRUCT<hits: ARRAY<STRUCT<_score: DOUBLE, _source: STRUCT<label: STRING, resource: STRING>>>>"
BINDINGS_SCHEMA = "results STRUCT<bindings: ARRAY<STRUCT<abstract: STRUCT<value: STRING>>>>"


def flatten_hits(responses: DataFrame, column: str = "json") -> DataFrame:
    """One row ``(…, pos, kb_id, label, search_score)`` per hit; responses without hits give no rows."""
    others = [c for c in responses.columns if c != column]
    hits = F.from_json(column, HITS_SCHEMA)["hits"]["hits"]
    return responses.select(*others, F.posexplode(hits).alias("pos", "hit")).select(
        *others,
        "pos",
        F.col("hit._source.resource").alias("kb_id"),
        F.col("hit._source.label").alias("label"),
        F.col("hit._score").alias("search_score"),
    )


def flatten_bindings(responses: DataFrame, column: str = "json") -> DataFrame:
    """One row ``(…, abstract)`` per graph result."""
    others = [c for c in responses.columns if c != column]
    bindings = F.from_json(column, BINDINGS_SCHEMA)["results"]["bindings"]
    return responses.select(*others, F.explode(bindings).alias("binding")).select(
        *others, F.col("binding.abstract.value").alias("abstract")
    )
