"""Audit of how sources diverge in their words, by ranking cells of counts instead of words.

Every source of a language gives each kept term of the language a smoothed share ``p``, and so does the language. A divergence ``f`` depends
on a term's two counts alone, so terms with the same (count here, count there) are one cell: ``f`` is worked out once a cell and counts as
often as the cell has terms. For the ranking of terms, cells with equal values are merged, the running number of terms above them tells
which values reach the report, and only their terms are looked up and put in UTF-8 order. For pairs of sources the terms that
neither or only one of them uses are cells too, whose sizes follow from the sizes of the others, so they never become rows.

Shares are whole billionths and all arithmetic is exact. Null language, source or text counts as empty. Every row is a document of its own,
also one that repeats another. Texts are counted in windows of bounded size, whatever their length; terms that many
texts share are added up in every task before they are shuffled. A source without terms still takes part. Ties are in UTF-8 order of
the item. Other columns play no part, whatever their names. Of an empty table nothing remains.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tether.llm.texts import slices
from tether.session import stored

MIN_DOCS, TOP = 3, 200
UNIT = 10**9
# Bytes of a text counted at once, and terms a task holds before it hands them on.
WINDOW, HELD = 1 << 21, 200_000
# Letters of ASCII in lower case and all bytes of other letters stay, the rest divides terms.
TERM_BYTES = bytes(b if b > 0x7F else ord(chr(b).lower()) if chr(b) in string.ascii_letters else 0x20 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    spaced, start = text.translate(TERM_BYTES), 0
    while start < len(spaced):
        end = spaced.find(b" ", start + WINDOW)
        end = len(spaced) if end < 0 else end
        yield spaced[start:end].split()
        start = end


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """``(lang, source, term, n, n_docs)``: uses and documents of each term, added up per task, so a term may have several rows."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]

    def handed_on(uses: dict, texts: dict) -> pa.RecordBatch:
        rows = [(*group, term, n, texts[group][term]) for group, counts in uses.items() for term, n in counts.items()]
        columns = list(zip(*rows)) or [(), (), (), (), ()]
        types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["lang", "source", "term", "n", "n_docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: dict[tuple, Counter] = {}
        texts: dict[tuple, Counter] = {}
        for batch in batches:
            column = batch.column("text")
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for a, b in slices(pc.binary_length(column).to_pylist()):
                for i, body in zip(range(a, b), column.slice(a, b - a).cast(pa.binary()).to_pylist()):
                    group = langs[i], sources[i]
                    seen: set[bytes] = set()
                    for terms in terms_of(body):
                        uses.setdefault(group, Counter()).update(terms)
                        seen.update(terms)
                    texts.setdefault(group, Counter()).update(seen)
                if sum(map(len, uses.values())) > HELD:
                    yield handed_on(uses, texts)
                    uses, texts = {}, {}
        yield handed_on(uses, texts)

    found = docs.select(*named).mapInArrow(run, "lang string, source string, term binary, n long, n_docs long")
    return found.withColumn("term", F.col("term").cast("string"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, total, uses)``: terms in enough documents of a language; ``uses`` has ``(source, n)``, ordered. A stored table."""
    # One shuffle serves both sums. The uses of a term are as many as the language has sources.
    summed = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    whole = summed.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("n_docs").alias("n_docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("uses")
    )
    return stored(whole.where(F.col("n_docs") >= min_docs).drop("n_docs"), "kept-terms")


def share(count: Column, size: Column, n_terms: Column) -> Column:
    """Smoothed share in billionths: ``1 + floor(10^9 (count + 1) / (size + n_terms))``."""
    exact = lambda c: c.cast("decimal(28,0)")
    return F.call_function("div", exact(count + 1) * F.lit(UNIT).cast("decimal(10,0)"), exact(size + n_terms)) + 1


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``."""
    return F.call_function("div", (p - q) * (p - q), q)


def _ranked_terms(uses: DataFrame, cells: DataFrame, top: int) -> DataFrame:
    """``(lang, source, item, value, rank)``: the first ``top`` terms of each source by value.

    ``uses`` is ``(lang, source, term, n, total)``; ``cells (lang, source, n, total, m, value)`` holds those that count.
    """
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    # Each value stands for a term at least, so no more than ``top`` of them matter.
    values = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    values = values.withColumn("place", F.row_number().over(by_value)).where(F.col("place") <= top)
    above = F.coalesce(F.sum("m").over(by_value.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("above", above).where(F.col("above") < top).select("lang", "source", "value", "above")
    chosen = stored(cells.join(values, ["lang", "source", "value"]).select("lang", "source", "n", "total", "value", "above"), "chosen-cells")
    in_value = W.partitionBy("lang", "source", "value").orderBy("term")
    named = uses.join(chosen, ["lang", "source", "n", "total"]).withColumn("place", F.row_number().over(in_value)).where(F.col("place") <= top)
    rank = F.col("above") + F.col("place")
    return named.where(rank <= top).select("lang", "source", F.col("term").alias("item"), "value", rank.cast("int").alias("rank"))


def _pair_cells(kept: DataFrame, cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(lang, source, item, c, d, m)``: of each pair of sources, how many terms the first has ``c`` times and the second ``d`` times.

    ``cells`` is ``(lang, source, n, m)``, ``pairs`` is ``(lang, source, item, n_terms)``. Terms that only one uses are all that it has with
    that count but those both use, and terms that neither uses are the rest, so each cell is a sum of signed rows.
    """
    # Terms with the same uses in all sources are one row before their pairs are made.
    alike = kept.groupBy("lang", "uses").agg(F.count("*").alias("m"))
    one = alike.select("lang", "m", "uses", F.explode("uses").alias("one"))
    two = one.select("lang", "m", "one", F.explode("uses").alias("two")).where("one.source <> two.source")
    both = two.groupBy("lang", F.col("one.source").alias("source"), F.col("two.source").alias("item"), F.col("one.n").alias("c"), F.col("two.n").alias("d")).agg(F.sum("m").alias("m"))

    def signed(rows: DataFrame, *cells: tuple) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(c).cast("long").alias("c") if isinstance(c, int) else F.col(c).alias("c"), F.lit(d).cast("long").alias("d") if isinstance(d, int) else F.col(d).alias("d"), m.alias("m")) for c, d, m in cells])
        return rows.select("lang", "source", "item", F.explode(entries).alias("cell")).select("lang", "source", "item", "cell.*")

    m = F.col("m")
    first = pairs.join(cells.withColumnRenamed("n", "c"), ["lang", "source"])
    second = pairs.join(cells.select("lang", F.col("source").alias("item"), F.col("n").alias("d"), "m"), ["lang", "item"])
    rows = (
        signed(pairs, (0, 0, F.col("n_terms")))
        .unionByName(signed(first, ("c", 0, m), (0, 0, -m)))
        .unionByName(signed(second, (0, "d", m), (0, 0, -m)))
        .unionByName(signed(both, ("c", "d", m), ("c", 0, -m), (0, "d", -m), (0, 0, m)))
    )
    return rows.groupBy("lang", "source", "item", "c", "d").agg(F.sum("m").alias("m"))


def divergence_audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair`` has the other sources of the language by their summed divergence from this one, all of them; part ``term`` has the terms that
    the source uses more than its language does, the first ``top`` by divergence. Runs jobs and stores tables.
    """
    kept = kept_terms(term_counts(docs, lang, source, text), min_docs)
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))]).distinct()
    uses = kept.select("lang", "term", "total", F.explode("uses").alias("use")).select("lang", "use.source", "term", "use.n", "total")
    cells = stored(uses.groupBy("lang", "source", "n", "total").agg(F.count("*").alias("m")), "cells")
    whole = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("total").alias("lang_size"))
    sizes = cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("size"))
    sized = groups.join(whole, "lang", "left").join(sizes, ["lang", "source"], "left").fillna(0, ["n_terms", "lang_size", "size"])
    sized = stored(sized, "sources")

    p, q = share(F.col("n"), F.col("size"), F.col("n_terms")), share(F.col("total"), F.col("lang_size"), F.col("n_terms"))
    judged = cells.join(sized, ["lang", "source"]).select("lang", "source", "n", "total", "m", p.alias("p"), q.alias("q")).where("p > q")
    terms = _ranked_terms(uses, judged.withColumn("value", gap(F.col("p"), F.col("q"))).drop("p", "q"), top)

    other = sized.select("lang", F.col("source").alias("item"), F.col("size").alias("item_size"))
    pairs = sized.join(other, "lang").where("source <> item").select("lang", "source", "item", "n_terms", "size", "item_size")
    by_count = cells.groupBy("lang", "source", "n").agg(F.sum("m").alias("m"))
    counted = _pair_cells(kept, by_count, pairs.select("lang", "source", "item", "n_terms")).join(pairs, ["lang", "source", "item"])
    # Of a language without terms no cell is left, and its pairs stand at 0.
    in_use = counted.where("m > 0").select("lang", "source", "item", "m", share(F.col("c"), F.col("size"), F.col("n_terms")).alias("p"), share(F.col("d"), F.col("item_size"), F.col("n_terms")).alias("q"))
    summed = in_use.groupBy("lang", "source", "item").agg(F.sum(gap(F.col("p"), F.col("q")).cast("decimal(28,0)") * F.col("m")).alias("value"))
    valued = pairs.join(summed, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce(F.col("value").cast("long"), F.lit(0)).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = valued.withColumn("rank", F.row_number().over(order).cast("int"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
