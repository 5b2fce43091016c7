"""Feistel permutations as column expressions (built-in functions only).

``permute`` is a bijection of {0 .. a*b-1}: the number splits into a left
half modulo ``a`` and a right half modulo ``b``; each round adds a keyed
function of one half to the other, which can be undone, so every round and
the whole is a permutation. ``cycle_walk`` narrows it to {0 .. n-1}: a value
that lands outside is permuted again until it is inside.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rounds of the network, and the prime of the arithmetic round function.
ROUNDS = 8
PRIME = 2_147_483_647


def sides(n: int) -> tuple[int, int]:
    """The smallest near-square (a, b) with a * b >= n; fewer than a values lie outside n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def round_keys(key: str, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """A multiplier and an offset per round, both below PRIME, drawn from ``key`` by SHA-256."""
    out = []
    for i in range(rounds):
        h = hashlib.sha256(f"{key}|{i}".encode()).digest()
        out.append((1 + int.from_bytes(h[:8], "big") % (PRIME - 1), int.from_bytes(h[8:16], "big") % PRIME))
    return out


def arithmetic_round(half: Column, mult: Column, offset: Column) -> Column:
    """((half^2 mod p) * m + c)^2 mod p: every product stays below 2^62."""
    p = F.lit(PRIME).cast("long")
    first = ((half * half) % p * mult + half + offset) % p
    return first * first % p


def permute(x: Column, a: int, b: int, key: str,
            round_function: Callable[[Column, Column, Column], Column] = arithmetic_round) -> Column:
    """The permutation of {0 .. a*b-1} that ``key`` selects, applied to a long column.

    Both sides must be below PRIME. The rounds run as one fold over the key
    list, so the expression does not double with each round.
    """
    if not (0 < a < PRIME and 0 < b < PRIME):
        raise ValueError("sides must be positive and below 2^31 - 1")
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).cast("long").alias("m"), F.lit(c).cast("long").alias("c"))
                     for i, (m, c) in enumerate(round_keys(key))])
    la, lb = F.lit(a).cast("long"), F.lit(b).cast("long")

    def step(acc: Column, k: Column) -> Column:
        left, right = acc["l"], acc["r"]
        even = k["i"] % 2 == 0
        return F.struct(
            F.when(even, (left + round_function(right, k["m"], k["c"])) % la).otherwise(left).alias("l"),
            F.when(even, right).otherwise((right + round_function(left, k["m"], k["c"])) % lb).alias("r"))

    lx = x.cast("long")
    first = F.struct(F.call_function("div", lx, lb).alias("l"), F.pmod(lx, lb).alias("r"))
    return F.aggregate(keys, first, step, lambda acc: acc["l"] * lb + acc["r"])


#: Longest walk that one expression follows. Fewer than sqrt(n) + 1 values lie outside n, so up to
#: n = 3,969 no walk can be longer; beyond, 64 steps outside in a row have a chance below n^-31.
WALK = 64


def cycle_walk(x: Column, n: int, key: str,
               round_function: Callable[[Column, Column, Column], Column] = arithmetic_round) -> Column:
    """The permutation of {0 .. n-1}: permute until the value is inside; an endless walk raises an error."""
    a, b = sides(n)
    first = permute(x, a, b, key, round_function)
    if a * b == n:
        return first
    inside = F.lit(n).cast("long")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first,
                         lambda acc, _: F.when(acc >= inside, permute(acc, a, b, key, round_function)).otherwise(acc))
    settled = F.when(first < inside, first).otherwise(walked)  # most values need no walk
    return F.when(settled < inside, settled).when(x.isNull(), F.lit(None).cast("long")).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("long"))
