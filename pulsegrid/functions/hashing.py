"""Repeatable pseudo-random numbers: a hash of seed and key, so a retried task gives the same values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(*parts: Column, seed: int = 42, mode: str = "xxhash64") -> Column:
    """Uniform double in [0, 1) from ``seed`` and the key parts.

    ``xxhash64`` is the fast default; ``md5`` can be reproduced by any SQL engine.
    """
    if mode == "xxhash64":
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
        return bits.cast("double") * F.lit(2.0**-53)
    if mode == "md5":
        digits = md5_key(*parts, seed=seed).substr(1, 8)
        return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(2.0**32)
    raise ValueError(f"unknown hash mode {mode!r}")


def md5_key(*parts: Column, seed: int = 42) -> Column:
    """Hex digest of ``seed:part:part...``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def permuted(index: Column, size: Column, *parts: Column, seed: int = 42, mode: str = "xxhash64", rounds: int = 16) -> Column:
    """A pseudorandom permutation of 0 .. ``size`` - 1 that depends on ``seed`` and ``parts``, one number at a time.

    In each round the numbers are paired, x with (a hash - x) modulo ``size``, and each pair swaps or stays by a hash of
    its larger number; both numbers of a pair see the same, so no number is lost. ``md5`` takes sizes up to 2^32.
    """

    def swap(x: Column, k: Column) -> Column:
        turn = F.floor(unit_hash(*parts, F.lit("pair"), k, seed=seed, mode=mode) * size)
        partner = F.pmod(turn - x, size)
        stays = unit_hash(*parts, F.lit("swap"), k, F.greatest(x, partner), seed=seed, mode=mode) < 0.5
        return F.when(stays, x).otherwise(partner)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), swap)
