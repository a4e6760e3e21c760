"""Seeded draws from a row key.

A draw depends on the seed and the key only, so it stays the same however the
rows are partitioned and when a lost task is run again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = 16.0 ** 8


def key_digest(key: Column, seed: int | str) -> Column:
    """Hex digest of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def _slice(digest: Column, index: int) -> Column:
    return F.conv(F.substring(digest, 8 * index + 1, 8), 16, 10).cast("double")


def hash_uniform(key: Column, seed: int | str) -> Column:
    """A uniform draw strictly between 0 and 1."""
    return (_slice(key_digest(key, seed), 0) + 0.5) / F.lit(_SPAN)


def hash_normal(key: Column, seed: int | str, sd: float = 1.0) -> Column:
    """A normal draw with mean 0, by Box and Muller from two slices of the digest."""
    digest = key_digest(key, seed)
    first = (_slice(digest, 0) + 0.5) / F.lit(_SPAN)
    second = (_slice(digest, 1) + 0.5) / F.lit(_SPAN)
    return F.lit(float(sd)) * F.sqrt(F.lit(-2.0) * F.ln(first)) * F.cos(F.lit(2.0 * math.pi) * second)


def hash_choice(key: Column, seed: int | str, values: tuple[str, ...]) -> Column:
    """One of a short list of values, each as likely."""
    position = F.floor(hash_uniform(key, seed) * len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)
