"""Position-wise string similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming_similarity(a: Column, b: Column) -> Column:
    """One minus the share of differing positions, over the longer word; the longer word's tail differs. Two empty words: 1.0."""
    longer = F.greatest(F.length(a), F.length(b))
    same = F.zip_with(F.split(a, "", -1), F.split(b, "", -1), lambda x, y: (x == y) & (x != ""))
    equal = F.size(F.filter(same, lambda hit: hit))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1.0 - (longer - equal) / longer)


def allowed_differences(length: Column, threshold: float) -> Column:
    """Largest number of differing positions with which a word of ``length`` still exceeds ``threshold``.

    Settled by the same floating-point comparison as the similarity itself, so boundary words agree exactly.
    """
    guess = F.ceil(length * F.lit(1.0 - threshold)).cast("int")

    def passes(d: Column) -> Column:
        return (1.0 - d / length) > threshold

    return F.when(passes(guess), guess).when(passes(guess - 1), guess - 1).otherwise(F.greatest(guess - 2, F.lit(0)))
