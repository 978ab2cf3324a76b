"""Reproducible buckets: the same row lands in the same bucket on every engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_number(key: Column) -> Column:
    """The first 32 bits of the key's md5 as a bigint."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")


def bucket(key: Column, buckets: int | Column) -> Column:
    """Bucket 0 .. buckets-1 of a key."""
    return hash_number(key) % F.lit(buckets)


def split_name(key: Column, shares: dict[str, int], buckets: int = 100) -> Column:
    """Name of the split a key falls in; shares are counted in ``buckets``-ths."""
    number = bucket(key, buckets)
    upper, out = 0, None
    for name, share in shares.items():
        upper += share
        out = F.when(number < upper, name) if out is None else out.when(number < upper, name)
    if upper != buckets:
        raise ValueError(f"shares must add up to {buckets}")
    return out
