"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

Vectors are scaled to length one. Each table projects them on random directions, adds a random offset and rounds down to whole steps; the
steps of all directions of a table are its bucket. Near vectors share a bucket in some table with high probability, and the cosine of
every two vectors in a bucket decides. Two vectors that meet in several tables are counted in the first of them.

Equal vectors are one class and are compared once. Only vectors with equal labels and equal numbers of components are compared. Vectors that
are null, empty, zero, or hold null or non-finite components, and rows with null labels, link with nothing. Repeated rows count as
vectors of their own; other columns are left out.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tether.llm.groups import components, dealt_in_blocks, map_groups
from tether.session import stored

THRESHOLD = 0.98
# Two vectors at cosine 0.98 (distance 0.2) share a bucket of one table with probability 0.28, and one of all with 0.9997. Unrelated
# vectors (distance 1.41) share one with 2e-5. More directions a table suit more vectors a label, with more tables for the same recall.
TABLES, DIRECTIONS, WIDTH = 24, 12, 1.6
BLOCK = 1024
SEED = 11


@functools.lru_cache(maxsize=8)
def _projections(size: int, tables: int, directions: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions of standard normal components, which is what makes the projected distance stable; offsets; mixing factors."""
    draw = np.random.default_rng([SEED, size])
    axes = draw.normal(size=(size, tables * directions)) / width
    return axes, draw.uniform(size=tables * directions), draw.integers(1, 2**62, (tables, directions), dtype=np.int64) * 2 + 1


def buckets(vectors: np.ndarray, tables: int = TABLES, directions: int = DIRECTIONS, width: float = WIDTH) -> np.ndarray:
    """``(vectors, tables)`` bucket numbers of vectors of length one."""
    axes, offsets, factors = _projections(vectors.shape[1], tables, directions, width)
    steps = np.floor(vectors @ axes + offsets).astype(np.int64).reshape(len(vectors), tables, directions)
    mixed = (steps * factors).sum(axis=2)
    return mixed ^ (mixed >> 29)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length scaled to length one."""
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def new_links(vectors: np.ndarray, keys: np.ndarray, table: int, copies: np.ndarray, apart: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Inside one bucket: vectors linked with each vector, copies counted, and the first place each is connected with.

    ``keys`` are the buckets of all tables: a pair that met in an earlier table is left to that one. ``apart`` gives the block of each
    vector when two blocks meet; pairs inside one block then are left to that block.
    """
    n = len(vectors)
    near = np.zeros((n, n), dtype=bool)
    a, b = np.nonzero(vectors @ vectors.T >= threshold)
    fresh = (a != b) & ((apart[a] != apart[b]) | (apart.min() == apart.max()))
    a, b = a[fresh], b[fresh]
    for i in range(0, len(a), 1 << 18):
        x, y = a[i : i + (1 << 18)], b[i : i + (1 << 18)]
        first = ~(keys[x, :table] == keys[y, :table]).any(axis=1)
        near[x[first], y[first]] = True
    counts = near @ copies
    roots = np.full(n, -1)
    for start in range(n):
        if roots[start] < 0:
            frontier = np.array([start])
            while len(frontier):
                roots[frontier] = start
                met = np.flatnonzero(near[frontier].any(axis=0))
                frontier = met[roots[met] < 0]
    return counts, roots


def embedding_links(rows: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(key, n_links, component_id, kept)``, one row per input row. Runs jobs and stores tables."""
    given = rows.select(F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    sound = F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    given = given.withColumn("vector", F.when(F.coalesce(sound, F.lit(False)), F.transform("vector", lambda x: x + 0.0)))
    hashed = F.xxhash64("label", "vector")
    usable = given.where("vector is not null").withColumn("hashed", hashed)
    grouped = usable.groupBy("hashed", "label", "vector").agg(F.count("*").alias("copies"), F.min("key").alias("first"))
    # Stored at once, so that a class keeps its number when tasks are run again.
    classes = stored(grouped.withColumn("class", F.monotonically_increasing_id()).withColumn("size", F.size("vector")), "classes")

    # Buckets, by table.
    def in_buckets(batches):
        for batch in batches:
            sizes, numbers = batch.column("size").to_numpy(), batch.column("class").to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                keys = buckets(_matrix(batch.column("vector").take(pa.array(at))))
                yield pa.RecordBatch.from_pydict({"class": pa.array(numbers[at]), "keys": pa.array(keys.tolist(), type=pa.list_(pa.int64()))})

    keys = stored(classes.select("class", "size", "vector").mapInArrow(in_buckets, "class long, keys array<bigint>"), "buckets")
    labels = classes.select("class", "label", "size")
    met = keys.select("class", F.posexplode("keys").alias("slot", "bucket")).join(labels, "class")
    met = met.select("class", F.col("slot").cast("long").alias("slot"), F.xxhash64("bucket", "label", "size").alias("part"))
    dealt = dealt_in_blocks(met, ["slot", "part"], "class", BLOCK)
    full = dealt.join(classes.select("class", "label", "vector", "copies"), "class").join(keys, "class")

    def work(table: pa.Table, starts: np.ndarray) -> dict:
        table = table.combine_chunks()
        numbers, copies, slots = (table.column(c).to_numpy() for c in ("class", "copies", "slot"))
        halves = np.where(table.column("p").to_numpy() == table.column("q").to_numpy(), 0, table.column("own").to_numpy())
        names = np.asarray(table.column("label").to_pylist(), dtype=object)
        out = {"class": [], "links": [], "root": []}
        vectors, keyed = (table.column(c).chunk(0) for c in ("vector", "keys"))
        for a, b in zip(starts, np.append(starts[1:], len(table))):
            part = vectors.slice(a, b - a)
            sizes = np.diff(part.offsets.to_numpy())
            # A bucket's hash may bring other labels or lengths together: these are compared apart.
            for name, size in {(n, s) for n, s in zip(names[a:b], sizes)}:
                at = np.flatnonzero((names[a:b] == name) & (sizes == size))
                if len(at) < 2:
                    continue
                own = keyed.slice(a, b - a).take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
                counts, roots = new_links(_matrix(part.take(pa.array(at))), own, int(slots[a]), copies[a:b][at], halves[a:b][at], threshold)
                some = np.flatnonzero(counts)
                out["class"].append(numbers[a:b][at][some])
                out["links"].append(counts[some])
                out["root"].append(numbers[a:b][at][roots[some]])
        return {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, dtype=np.int64) for k, v in out.items()}

    found = stored(map_groups(full, ["slot", "part", "p", "q"], work, "class long, links long, root long"), "links")
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    member = classes.select("class", "hashed", "label", "vector", "copies", "first").join(linked, "class", "left").join(roots, F.col("class") == F.col("node"), "left")
    member = member.withColumn("root", F.coalesce("root", "class"))
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(named, "root").select(
        "hashed", F.col("label").alias("class_label"), F.col("vector").alias("class_vector"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    # Only the class's own hash is needed to find it; label and vector tell apart what the hash might bring together.
    mapped = given.withColumn("hashed", F.when(F.col("vector").isNotNull(), hashed))
    same = (F.col("label") == F.col("class_label")) & (F.col("vector") == F.col("class_vector"))
    joined = mapped.alias("g").join(named.alias("n"), (F.col("g.hashed") == F.col("n.hashed")) & same, "left")
    component = F.coalesce("component_id", "key")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )
