"""Keyed hashes that any SQL engine can repeat: splits and resampling weights without a seed state."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Mersenne prime 2^31 - 1, modulus of the replicate hash.
PRIME = 2147483647

# Cumulative Poisson(1) probabilities in units of 1/PRIME; a draw counts how many it reaches.
# Beyond 12 the probability is less than one unit.
POISSON_STEPS = tuple(
    int(PRIME * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(13)
)
HASH_BITS = 60


def key_hash(key: str | Column, salt: str = "") -> Column:
    """60-bit hash of a text key, uniform in [0, 2^60)."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    if salt:
        text = F.concat(text, F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def unit_hash(key: str | Column, salt: str = "") -> Column:
    """Uniform double in [0, 1)."""
    return key_hash(key, salt).cast("double") / F.lit(float(2**HASH_BITS))


def replicate_seeds(key: str | Column, salt: str = "") -> tuple[Column, Column]:
    """Two independent seeds below PRIME taken from one md5 of the key."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    digest = F.md5(F.concat(text, F.lit(salt)) if salt else text)
    first = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") % PRIME
    second = F.conv(F.substring(digest, 13, 12), 16, 10).cast("bigint") % PRIME
    return first, second


def poisson_weight(slope: Column, offset: Column, replicate: Column) -> Column:
    """Poisson(1) weight of a row in a replicate.

    The draw is (slope * replicate + offset) mod PRIME. Rows get independent seeds and, for one
    row, draws of different replicates are pairwise independent, which is what makes replicates
    of a sum uncorrelated. Integer arithmetic only, so one md5 per row serves all replicates.
    """
    u = (slope * replicate.cast("bigint") + offset) % PRIME
    weight = F.lit(0)
    for step in POISSON_STEPS:
        weight = weight + F.when(u >= step, 1).otherwise(0)
    return weight
