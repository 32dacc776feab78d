"""Key hashes: the same row gets the same draw in any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 60  # 15 hex digits of the digest, a non-negative long


def key_digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")).cast("binary"))


def key_hash(key: Column, seed: int) -> Column:
    """A long in [0, 2**60), uniform over keys; orders rows as their digests do."""
    return F.conv(F.substring(key_digest(key, seed), 1, HASH_BITS // 4), 16, 10).cast("long")


def key_fraction(key: Column, seed: int) -> Column:
    """``key_hash`` scaled to [0, 1)."""
    return key_hash(key, seed) / F.lit(float(1 << HASH_BITS))


def key_fold(key: Column, seed: int, folds: int) -> Column:
    """Fold number in [0, folds) from the first 32 bits of the digest."""
    return (F.conv(F.substring(key_digest(key, seed), 1, 8), 16, 10).cast("long") % folds).cast("int")


def row_hash(columns: list[Column]) -> Column:
    """A long in [0, 2**60) from a row's text form; each part carries its length, so no two rows have one form."""
    texts = [x.cast("string") for x in columns]
    parts = [F.coalesce(F.concat(F.length(x).cast("string"), F.lit("="), x), F.lit("~")) for x in texts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")
