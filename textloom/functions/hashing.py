"""Keyed randomness: every draw is a hash of (seed, document, purpose), so results do not depend on order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 1 << 32


def digest(seed: int | str, key: Column, purpose: str | Column) -> Column:
    """Hex sha256 of seed, key and purpose; an order as well as a source of draws."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")), purpose if isinstance(purpose, Column) else F.lit(purpose)), 256)


def draw(seed: int | str, key: Column, purpose: str | Column) -> Column:
    """Uniform BIGINT in [0, 2**32)."""
    return F.conv(F.substring(digest(seed, key, purpose), 1, 8), 16, 10).cast("bigint")


def uniform(seed: int | str, key: Column, purpose: str | Column, low: float = 0.0, high: float = 1.0) -> Column:
    u = draw(seed, key, purpose) / F.lit(float(SPAN))
    return u if (low, high) == (0.0, 1.0) else F.lit(low) + u * F.lit(high - low)


def randint(seed: int | str, key: Column, purpose: str | Column, low: Column | int, high: Column | int) -> Column:
    """Whole number from low to high, both included."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return (low + draw(seed, key, purpose) % (high - low + 1)).cast("int")


def sql_draw(seed: int | str, key: str, purpose: str) -> str:
    """DuckDB text of draw()."""
    return f"(('0x' || substr(sha256(concat_ws('|', '{seed}', coalesce({key}::varchar, ''), '{purpose}')), 1, 8))::bigint)"


def sql_digest(seed: int | str, key: str, purpose: str) -> str:
    return f"sha256(concat_ws('|', '{seed}', coalesce({key}::varchar, ''), '{purpose}'))"
