"""An equi-join that splits keys whose pairs would be too many for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tether.session import stored

# Pairs one task may be given for one key, and right-hand rows below which a key is never worth splitting: what its left-hand rows
# read and make grows together then, and adaptive execution splits those by size.
PAIRS_PER_TASK = 50_000_000
LIGHT_ROWS = 100
# Split keys up to this number are sent to every task: 24 bytes each.
BROADCAST_KEYS = 1_000_000


def with_few(rows: DataFrame) -> DataFrame:
    """``rows``, a stored table, to be sent to every task of a join if it has at most ``BROADCAST_KEYS`` rows."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_KEYS else rows


def heavy_keys(right: DataFrame, on: str) -> DataFrame:
    """``(on, n_right)`` for keys with many right-hand rows."""
    return right.groupBy(on).agg(F.count("*").alias("n_right")).where(F.col("n_right") > LIGHT_ROWS)


def split_keys(left: DataFrame, heavy: DataFrame, on: str) -> DataFrame:
    """``(on, rows, columns)`` for keys with too many pairs: into how many shares their left-hand and their right-hand rows go.

    The pairs of a key are a rectangle, cut into tiles as square as its sides allow, since a row is copied once for each tile it lies in.
    """
    side = PAIRS_PER_TASK**0.5
    shares = lambda n, other: F.ceil(n / F.greatest(F.lit(side), F.lit(float(PAIRS_PER_TASK)) / other))
    n_left, n_right = F.col("n_left").cast("double"), F.col("n_right").cast("double")
    counted = left.select(on).join(heavy, on).groupBy(on).agg(F.count("*").alias("n_left"), F.max("n_right").alias("n_right"))
    return counted.where(n_left * n_right > PAIRS_PER_TASK).select(on, shares(n_left, n_right).alias("rows"), shares(n_right, n_left).alias("columns"))


def _tiles(df: DataFrame, split: DataFrame, on: str, own: str, other: str) -> DataFrame:
    """``df`` with its place ``own`` among the shares of its key, once for each share of the ``other`` side."""
    n_own, n_other = (F.coalesce(c, F.lit(1).cast("long")) for c in (own, other))
    place: Column = F.pmod(F.xxhash64(*df.columns), n_own)
    joined = df.join(split, on, "left").select(*df.columns, place.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), n_other - 1)).alias("other"))
    return joined.select(*df.columns, F.col("own").alias(f"tile_{own}"), F.col("other").alias(f"tile_{other}"))


def balanced_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join on ``on`` that stays even when few keys hold most pairs. ``right`` should be the smaller side.

    Its keys are counted first; only if some are heavy are those counted on the left too. So ``right`` is read twice, and ``left`` is where
    keys are heavy: both should be stored tables, or cheap.

    Adaptive execution splits partitions by the bytes they hold, which tells nothing of the pairs they make. Here the rows of a heavy key
    are dealt into shares by their own hash on either side, so a retried task deals them the same way, and each two shares meet in a task.
    """
    heavy = stored(heavy_keys(right, on), "heavy-keys")
    if heavy.isEmpty():
        return left.join(right, on)
    split = stored(split_keys(left, heavy, on), "split-keys")
    n_keys = split.count()
    if n_keys == 0:
        return left.join(right, on)
    if n_keys <= BROADCAST_KEYS:
        split = F.broadcast(split)
    dealt = _tiles(left, split, on, "rows", "columns")
    met = dealt.join(_tiles(right, split, on, "columns", "rows"), [on, "tile_rows", "tile_columns"])
    return met.drop("tile_rows", "tile_columns")
