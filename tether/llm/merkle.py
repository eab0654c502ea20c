"""Merkle manifest of a dataset: a content-addressed tree of digests, and the proof of each row by descent from its root.

Leaves are digests of rows. Every ``fanout`` consecutive nodes become the digest of their digests, the last run being shorter, until one
node a group is left, the group's subroot; subroots in group order become the root the same way. The tree is stored as records from a
digest to what lies under it, ``HEIGHT`` levels a record, one record for each digest. Requests name a group and a rank. They start at the
root, and at each node the next digit of the rank selects a child; the others are collected. What a record adds to a path is reversed and put
before what the records above have given, so a path ends up in order from leaf to root. Requests that have their first digits in
common descend as one, and part at the record where their digits do.

Ranks come from a range partitioning and counts for each of its parts, so no group, however large, is sorted in one task; a task never holds
more than the parts of one record. Rows with a null group are a group that comes first, a null key comes before all others, and rows that
repeat a key are ordered by their digest, so equal rows have leaves of their own next to each other. Null values are told apart
from empty ones. Texts of any length are digested in the JVM and never moved. Other columns play no part, whatever their names. An
empty table has no root and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tether.llm.texts import crc32_of_id
from tether.session import stored

FANOUT = 2
# Levels under one record, which so has at most FANOUT ** HEIGHT nodes at its lowest level.
HEIGHT = 6
PATH = "array<struct<place: int, others: array<string>>>"
PATH_TYPE = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))]))
HEAD = pa.schema([("g", pa.string()), ("at", pa.int64()), ("digest", pa.string()), ("top", pa.string()), ("path", PATH_TYPE)])


class Tree(NamedTuple):
    """``tops (g, digest)``: what is left of each group; ``records (digest, steps, levels)``: one table for each round from the leaves up."""

    tops: DataFrame
    records: list[DataFrame]
    fanout: int


# In the row ----------------------------------------------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value, so values can be joined without losing where one ends."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def digest(digests: list[str]) -> str:
    """Lowercase hexadecimal SHA-256 of digests put one after the other as text."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_over(nodes: list[str], steps: int, fanout: int) -> list[list[str]]:
    """``nodes`` and the ``steps`` levels above them."""
    levels = [nodes]
    for _ in range(steps):
        levels.append([digest(levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def descended(levels: list[list[str]], rank: int, fanout: int) -> tuple[str, list[dict]]:
    """The node at ``rank`` of the lowest level, found from the top by the digits of the rank, and the path back up: ``place`` of the
    selected child in its run and the ``others`` of the run."""
    met, at = [], 0
    for level in range(len(levels) - 2, -1, -1):
        digit = rank // fanout**level % fanout
        run = levels[level][at * fanout : (at + 1) * fanout]
        met.append({"place": digit, "others": run[:digit] + run[digit + 1 :]})
        at = at * fanout + digit
    return levels[0][at], met[::-1]


def folded(leaf: str, path: list[dict]) -> str:
    """The root that ``leaf`` and the ``others`` on its path make."""
    for step in path:
        leaf = digest(step["others"][: step["place"]] + [leaf] + step["others"][step["place"] :])
    return leaf


# Ranks and trees -----------------------------------------------------------------------------------------------------------------


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0 in each group ``g`` in ``order``; a stored table."""
    dealt = stored(rows.repartitionByRange("g", *order).withColumn("part", F.spark_partition_id()), "by-range")
    before = W.partitionBy("g").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = dealt.groupBy("g", "part").agg(F.count("*").alias("n"))
    starts = sizes.select("g", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(W.partitionBy("g", "part").orderBy(*order)) - 1
    placed = dealt.withColumn("place", place).join(starts, ["g", "part"])
    return stored(placed.select(*rows.columns, (F.col("start") + F.col("place")).alias("rank")), "numbered")


def build(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> Tree:
    """Tree over ``leaves (g, rank, digest)``. Runs a job and stores a table for each ``height`` levels."""
    span, records = fanout**height, []
    nodes = leaves.select("g", F.col("rank").alias("at"), "digest")
    # Levels of each group: the steps until one node is left.
    powers = F.array(*[F.lit(p) for p in (fanout**i for i in range(64)) if p < 1 << 62])
    left = nodes.groupBy("g").agg(F.count("*").alias("n")).select("g", F.size(F.filter(powers, lambda p: p < F.col("n"))).alias("left"))
    left = stored(left, "levels")
    deepest = left.agg(F.max("left")).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [levels_over([x["digest"] for x in nodes], n, fanout) for nodes, n in zip(batch.column("nodes").to_pylist(), batch.column("steps").to_pylist())]
            tops = pa.array([levels[-1][0] for levels in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("g"), batch.column("at"), tops, batch.column("steps"), pa.array(found, pa.list_(pa.list_(pa.string())))],
                ["g", "at", "digest", "steps", "levels"],
            )

    for done in range(0, max(deepest, 1), height):
        runs = nodes.groupBy("g", F.floor(F.col("at") / span).alias("at")).agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("nodes"))
        steps = F.greatest(F.lit(0), F.least(F.lit(height), F.col("left") - done))
        made = runs.join(left, "g").select("g", "at", "nodes", steps.alias("steps"))
        made = stored(made.mapInArrow(run, "g string, at long, digest string, steps int, levels array<array<string>>"), "tree")
        records.append(made.select("digest", "steps", "levels").dropDuplicates(["digest", "steps"]))
        nodes = made.select("g", "at", "digest")
    return Tree(nodes.select("g", "digest"), records, fanout)


def descend(tree: Tree, heads: DataFrame, requests: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``(g, top, path, asked, levels)``: requests where they part for the last time, those under one lowest record in one row.

    ``heads (g, digest, path)`` are the tops of groups with the path above them. ``requests (g, rank, …)`` may be all leaves or some. ``asked``
    holds the requests as they are; ``levels`` is the lowest record on their way, ``path`` what the records above have given.
    """
    span, fanout = tree.fanout**height, tree.fanout
    rest = [c for c in requests.columns if c != "g"]
    heads = heads.select("g", F.lit(0).cast("long").alias("at"), "digest", F.col("digest").alias("top"), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for digit in row["digits"]:
                    node, path = descended(row["levels"], digit, fanout)
                    rows.append({"g": row["g"], "at": row["at"] * span + digit, "digest": node, "top": row["top"], "path": path + row["path"]})
            yield pa.RecordBatch.from_pylist(rows, schema=HEAD)

    for i in range(len(tree.records) - 1, -1, -1):
        below = F.floor(F.col("rank") / span**i)
        under = requests.withColumn("at", F.floor(below / span))
        if i:
            asked = under.groupBy("g", "at").agg(F.collect_set((below % span).cast("int")).alias("digits"))
        else:
            asked = under.groupBy("g", "at").agg(F.collect_list(F.struct(*rest)).alias("asked"))
        met = heads.join(asked, ["g", "at"]).join(tree.records[i].drop("steps"), "digest")
        if not i:
            return met.select("g", "top", "path", "asked", "levels")
        moving = met.select("g", "at", "digest", "top", "path", "levels", "digits")
        heads = stored(moving.mapInArrow(run, f"g string, at long, digest string, top string, path {PATH}"), "heads")


# Manifest and proofs of a table ----------------------------------------------------------------------------------------------------


def leaves_of(docs: DataFrame, key: str = "doc_id", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang") -> DataFrame:
    """``(g, key, digest, tampered)`` of all rows. ``g`` names the group and sorts as it does, null first; ``tampered`` is the digest of the
    row with 1 added to ``n_chars``, for rows whose key's checksum 7 divides, and otherwise the digest."""
    g = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    changed = [F.col(c).cast("decimal(38,0)") + 1 if c == "n_chars" else F.col(c) for c in columns]
    hit = F.col(key).isNotNull() & (crc32_of_id(key) % 7 == 0)
    read = docs.select(g.alias("g"), F.col(key).alias("key"), row_digest(*map(F.col, columns)).alias("digest"), F.when(hit, row_digest(*changed)).alias("tampered"))
    return read.withColumn("tampered", F.coalesce("tampered", "digest"))


def proofs(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)`` for all ``leaves (g, key, digest, tampered)``.

    ``proof_sha256`` digests the others on the path from the leaf to the root. ``folded_root`` is what the tampered leaf makes of
    them, ``verified`` whether that is the root. Runs jobs and stores tables.
    """
    leaves = numbered(leaves, ["key", "digest"])
    tree = build(leaves, fanout, height)
    tops = numbered(tree.tops.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), ["name"])
    above = build(tops, fanout, height)
    top = above.tops.first()
    root = top.digest if top else None

    def tops_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for ask in row["asked"]:
                    node, path = descended(row["levels"], ask["rank"] % fanout**height, fanout)
                    rows.append({"g": ask["name"], "digest": node, "path": path + row["path"]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([HEAD.field(c) for c in ("g", "digest", "path")]))

    start = above.tops.select("g", "digest", F.array().cast(PATH).alias("path"))
    heads = stored(descend(above, start, tops.select("g", "rank", "name"), height).mapInArrow(tops_paths, f"g string, digest string, path {PATH}"), "heads")
    asked = descend(tree, heads, leaves.select("g", "rank", "key", "tampered"), height)
    key_type = leaves.schema["key"].dataType.simpleString()

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("asked").flatten().field("key")
            out = {"leaf": [], "subroot": [], "proof_sha256": [], "folded_root": []}
            for row in batch.select(["top", "path", "asked", "levels"]).to_pylist():
                for ask in row["asked"]:
                    leaf, path = descended(row["levels"], ask["rank"] % fanout**height, fanout)
                    path += row["path"]
                    out["leaf"].append(leaf)
                    out["subroot"].append(row["top"])
                    out["proof_sha256"].append(digest([d for step in path for d in step["others"]]))
                    out["folded_root"].append(folded(ask["tampered"], path))
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(v, pa.string()) for v in out.values()]], ["key", *out])

    proved = asked.mapInArrow(prove, f"key {key_type}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proved.select("key", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"))


def manifest(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``proofs`` of all rows of ``docs``, with the key under its own name."""
    return proofs(leaves_of(docs, key)).withColumnRenamed("key", key)
