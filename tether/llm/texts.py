"""Whole texts to Python and back in Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text handled at once inside a task; a single longer text is handled alone.
SLICE_BYTES = 8 << 20


def slices(lengths: list[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """``(from, to)`` runs of texts that hold ``most`` bytes together, or one text."""
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def _array(values: list | pa.Array) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def map_texts(docs: DataFrame, key: str, text: str, work: Callable[[list], dict[str, list | pa.Array]], schema: str, binary: bool = False) -> DataFrame:
    """``(key, …schema)``: ``work`` gets a list of texts (``str``, or UTF-8 ``bytes``) and returns values by output column,
    in the order of ``schema``.

    Null texts are handed over as empty ones. Only the key and the text leave the JVM. Nothing is shuffled.
    """
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for a, b in slices(pc.binary_length(column).to_pylist()):
                part = column.slice(a, b - a)
                values = work((part.cast(pa.binary()) if binary else part).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(a, b - a), *map(_array, values.values())], ["key", *values])

    return source.mapInArrow(run, f"key {key_type}, {schema}").withColumnRenamed("key", key)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` is called so; case does not tell columns apart."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc32_of_id(key: str | Column) -> Column:
    """CRC-32 of an id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit("")).cast("binary"))


def held_out(key: str | Column) -> Column:
    """Rows kept out of all learning: a quarter of the ids, by checksum."""
    return crc32_of_id(key) % 4 == 2


def judged(docs: DataFrame, text: str, work: Callable[[list], dict[str, list | pa.Array]], schema: str, keep: Callable[[Column], Column], binary: bool = False) -> DataFrame:
    """Rows of ``docs`` for which ``keep`` holds of what ``work`` finds in the text; columns as they were. See ``map_texts``."""

    @F.arrow_udf(schema)
    def find(texts: pa.Array) -> pa.Array:
        found: dict[str, list[pa.Array]] = {}
        for a, b in slices(pc.binary_length(texts).to_pylist()):
            part = texts.slice(a, b - a)
            for name, values in work((part.cast(pa.binary()) if binary else part).to_pylist()).items():
                found.setdefault(name, []).append(_array(values))
        return pa.StructArray.from_arrays([pa.concat_arrays(parts) for parts in found.values()], list(found))

    name = free_name(docs, "found")
    return docs.withColumn(name, find(F.coalesce(F.col(text), F.lit("")))).where(keep(F.col(name))).drop(name)
