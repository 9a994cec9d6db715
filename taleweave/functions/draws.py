"""Reproducible random draws: every value is a function of (seed, purpose, key).

A draw never depends on partitioning, task retries or row order, so a lost
executor or a different cluster size gives the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(seed: int, purpose: str, *keys) -> Column:
    parts = [F.lit(str(seed)), F.lit(purpose)]
    parts += [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def shuffle_key(seed: int, purpose: str, *keys) -> Column:
    """Hex string that orders rows like a seeded shuffle."""
    return _digest(seed, purpose, *keys)


def _unit(digest: Column, first: int) -> Column:
    return F.conv(F.substring(digest, first, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def uniform(seed: int, purpose: str, *keys) -> Column:
    """Uniform value in [0, 1)."""
    return _unit(_digest(seed, purpose, *keys), 1)


def normal(seed: int, purpose: str, *keys) -> Column:
    """Standard normal value (Box-Muller on two halves of one digest)."""
    digest = _digest(seed, purpose, *keys)
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _unit(digest, 1)))
    return radius * F.cos(F.lit(2.0 * math.pi) * _unit(digest, 9))


def pick(options, draw: Column) -> Column:
    """Element of a list or array column chosen by a uniform draw."""
    array = F.array(*[F.lit(o) for o in options]) if isinstance(options, list) else options
    return F.get(array, F.floor(draw * F.size(array)).cast("int"))
