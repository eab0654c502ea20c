"""Groups of rows that share a key, compared inside tasks of bounded size, and what follows from the links found."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.session import stored


def dealt_in_blocks(rows: DataFrame, by: list[str], member: str, block: int, also: Column | None = None) -> DataFrame:
    """Rows whose group ``by`` has more than one, with ``(own, p, q)``: any two rows of a group meet in some ``(…by, p, q)``.

    ``own`` is the row's block, which is one of ``p`` and ``q``. Groups for which the aggregate ``also`` is false are left out.

    A group of up to ``block`` rows stays together. A larger one is cut into blocks by a hash of ``member``, and each two blocks meet, so
    no task gets much more than two blocks, and a row is copied once for each block of its own group.
    """
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"), (F.lit(True) if also is None else also).alias("also")).where("n > 1 and also").drop("also")
    cut = rows.join(sizes, by).withColumn("blocks", F.ceil(F.col("n") / block))
    cut = cut.withColumn("own", F.pmod(F.xxhash64(member), "blocks"))
    own = F.col("own")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda other: F.struct(F.least(own, other).alias("p"), F.greatest(own, other).alias("q")))
    return cut.select(*rows.columns, "own", F.explode(pairs).alias("pair")).select(*rows.columns, "own", "pair.p", "pair.q")


def map_groups(rows: DataFrame, by: list[str], work: Callable[[pa.Table, np.ndarray], dict[str, np.ndarray]], schema: str, at_once: int = 0) -> DataFrame:
    """``work`` gets whole groups, many at once, ordered by the whole numbers ``by``, with the row each group starts at.

    It is called when ``at_once`` bytes of rows have come, or after each batch.
    """

    def starts(table: pa.Table) -> np.ndarray:
        columns = [table.column(c).to_numpy() for c in by]
        changed = np.zeros(len(table), dtype=bool)
        changed[:1] = True
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(changed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if table.nbytes < at_once:
                held = table
                continue
            at = starts(table)
            held = table.slice(at[-1]) if len(at) else None
            if len(at) > 1:
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in work(table.slice(0, at[-1]), at[:-1]).items()})
        if held is not None and len(held):
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in work(held, starts(held)).items()})

    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``: the smallest node it is linked to, over any number of links.

    Each round hangs the larger neighbours of every node, then the smaller ones, on its smallest neighbour. A node with many links is
    never gathered: its smallest neighbour comes from a sum-like aggregate and goes back by a join. Each round is stored, which cuts
    the lineage. Runs jobs.
    """
    current = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "edges")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(smallest, "a")
        current = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(hung.select("a", F.col("m").alias("b")))
        current = stored(current.where("a <> b").distinct(), "edges")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
