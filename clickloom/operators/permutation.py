"""A keyed permutation of 0 to n - 1 as a column expression: each row computes its own place.

Swap or not: each round pairs x with k - x modulo n and, by a bit that both of a pair agree on,
swaps them or not. Every round is a permutation, whatever n is.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 40


def _hashed(*parts) -> Column:
    """The first 32 bits of the md5 of parts joined by slashes."""
    text = F.concat_ws("/", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def permuted(index: Column, n: int, *key) -> Column:
    """The place of ``index``, one of 0 to n - 1, in the order that ``key`` (values or columns)
    decides."""
    if n < 2:
        return index.cast("bigint")

    def swapped(x: Column, r: Column) -> Column:
        other = F.pmod(_hashed(*key, "k", r) - x, F.lit(n))
        bit = _hashed(*key, "b", r, F.greatest(x, other)) % 2
        return F.when(bit == 1, other).otherwise(x)

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, index.cast("bigint"), swapped)


def permuted_number(index: int, n: int, *key) -> int:
    """The same for one number."""
    hashed = lambda *parts: int(hashlib.md5("/".join(map(str, parts)).encode()).hexdigest()[:8], 16)
    for r in range(ROUNDS if n > 1 else 0):
        other = (hashed(*key, "k", r) - index) % n
        if hashed(*key, "b", r, max(index, other)) % 2:
            index = other
    return index
