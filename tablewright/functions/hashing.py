"""Row placement by hashed key: the same row always lands in the same sample, split or fold.

``DataFrame.sample`` and ``randomSplit`` draw per partition, so their result changes when the
input is read with another partitioning. A hash of the row's key does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The multiplicative (Knuth) hash on 32 bits.
MULTIPLIER = 2654435761
RANGE = 4294967296
# An odd number that sets seeds apart.
SEED_STEP = 668265263


def key_hash(*keys: str, seed: int = 42) -> Column:
    """64-bit hash of one or more key columns of any type."""
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def multiplicative_hash(key: str, seed: int = 42) -> Column:
    """32-bit hash of one integer key; plain arithmetic, so any SQL engine can repeat it.

    The seed moves the key before it is multiplied and the product after its upper half was folded in, so that draws of
    different seeds are not the same draw.
    """
    moved = F.pmod(F.pmod(F.col(key).cast("long"), F.lit(RANGE // 2)) + F.lit(seed * SEED_STEP % (RANGE // 2)), F.lit(RANGE // 2))
    product = F.pmod(moved * F.lit(MULTIPLIER), F.lit(RANGE))
    folded = F.pmod(product.bitwiseXOR(F.shiftright(product, 15)), F.lit(RANGE // 2))
    return F.pmod(folded * F.lit(MULTIPLIER), F.lit(RANGE))


def unit_from_hash(hashed: Column, bits: int) -> Column:
    """Map the low ``bits`` bits of a hash to [0, 1)."""
    return F.pmod(hashed, F.lit(2**bits)) / F.lit(float(2**bits))


def unit_draw(*keys: str, seed: int = 42, method: str = "xxhash64") -> Column:
    """A number in [0, 1) that depends on the key (and seed) only; 0 for a null key of the multiplicative hash."""
    if method == "xxhash64":
        return unit_from_hash(key_hash(*keys, seed=seed), 52)
    if method == "multiplicative":
        if len(keys) != 1:
            raise ValueError("the multiplicative hash takes one integer key")
        return F.coalesce(unit_from_hash(multiplicative_hash(keys[0], seed), 32), F.lit(0.0))
    raise ValueError(f"unknown hash method {method!r}")
