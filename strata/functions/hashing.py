"""Deterministic pseudo-randomness as a function of (seed, key).

A draw never depends on partitioning, task order or recomputation after an
executor loss: it is ``md5("<seed>:<salt>:...:<key>")``.  The same strings
are easy to build in any SQL engine, so every random step can be checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def seed_prefix(*parts: object) -> str:
    """``seed_prefix(42, 3) == "42:3:"``."""
    return "".join(f"{p}:" for p in parts)


def key_string(key: str | Sequence[str]) -> Column:
    keys = as_list(key)
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.concat_ws(":", *[F.col(k).cast("string") for k in keys])


def row_hash(key: str | Sequence[str], *parts: object) -> Column:
    """Hex md5 of ``"<parts...>:<key>"``; orders rows pseudo-randomly."""
    return F.md5(F.concat(F.lit(seed_prefix(*parts)), key_string(key)))


def uniform(hex_digest: Column, offset: int = 0) -> Column:
    """U[0,1) from 8 hex digits (32 bits) of a digest, starting at ``offset``."""
    return (F.conv(F.substring(hex_digest, 1 + offset, 8), 16, 10).cast("bigint")
            / F.lit(TWO_32))


def uniform_of(text: Column) -> Column:
    return uniform(F.md5(text))
