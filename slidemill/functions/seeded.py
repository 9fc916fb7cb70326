"""Randomness that depends only on a seed and a key, never on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_key(seed: int, key: Column, tag: str = "") -> Column:
    """md5 text that orders keys pseudo-randomly and identically on every run."""
    prefix = f"{seed}:{tag}:" if tag else f"{seed}:"
    return F.md5(F.concat(F.lit(prefix), key.cast("string")).cast("binary"))


def seeded_uniform(seed: int, key: Column, tag: str = "") -> Column:
    """A uniform number in [0, 1) from the first 8 hex digits of the seeded key."""
    head = F.substring(seeded_key(seed, key, tag), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)
