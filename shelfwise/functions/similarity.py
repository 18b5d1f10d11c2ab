"""Token set similarity: containment and Jaccard, weighted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token_score(left: Column, right: Column, containment: float = 0.72) -> Column:
    """F1 (0.72) and F2 (0.70); sets of distinct tokens, 0 if either is empty."""
    a, b = F.array_distinct(left), F.array_distinct(right)
    shared = F.size(F.array_intersect(a, b))
    smaller, union = F.least(F.size(a), F.size(b)), F.size(F.array_union(a, b))
    return F.when(smaller > 0, containment * F.try_divide(shared, smaller) + (1 - containment) * F.try_divide(shared, union)).otherwise(0.0)


#: Words of 64 bits in the signs of a token set.
SIGNS = 4


def token_signs(tokens: Column) -> Column:
    """Struct of a token set's size and one bit for each token, for ``may_score``."""

    def word(k: int) -> Column:
        bit = lambda t: F.when(F.pmod(F.shiftright(F.xxhash64(t), 8), F.lit(SIGNS)) == k, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))).otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.array_distinct(tokens), F.lit(0).cast("long"), lambda a, t: a.bitwiseOR(bit(t)))

    return F.struct(F.size(F.array_distinct(tokens)).alias("n"), *[word(k).alias(f"b{k}") for k in range(SIGNS)])


def may_score(a: Column, b: Column, least: float, containment: float = 0.72) -> Column:
    """Whether ``token_score`` can be ``least``, told from ``token_signs`` alone: a bit that the other side lacks is a token it lacks."""

    def held(x: Column, y: Column) -> Column:
        lacks = F.lit(0)
        for k in range(SIGNS):
            lacks = lacks + F.bit_count(x[f"b{k}"].bitwiseAND(F.bitwise_not(y[f"b{k}"])))
        return x["n"] - lacks

    shared, smaller = F.least(held(a, b), held(b, a)), F.least(a["n"], b["n"])
    union = a["n"] + b["n"] - shared
    return containment * shared * union + (1 - containment) * shared * smaller >= (least - 1e-9) * smaller * union
