"""Deterministic md5-derived numbers.

Spark has no seeded, partition-independent ``rand`` per key, so every random
choice (splits, folds, draws, candidate points) is a function of md5 of a key
string. The first 8 hex digits give an unsigned 32-bit integer; the same value
is computable in any SQL engine, which makes the choices checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def md5_u32(*parts: Column | str) -> Column:
    """Unsigned 32-bit integer from md5 of ``'|'``-joined parts (as bigint)."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    key = F.concat_ws("|", *[c.cast("string") for c in cols]) if len(cols) > 1 else cols[0].cast("string")
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def md5_unit(*parts: Column | str) -> Column:
    """Uniform-looking double in [0, 1) from md5 of the joined parts."""
    return md5_u32(*parts) / F.lit(TWO_32)


def hash_split(key: Column, train: int = 70, val: int = 10) -> Column:
    """Split name from an md5 bucket (0..99) of the key: train / val / test."""
    bucket = F.pmod(md5_u32(key), F.lit(100))
    return (F.when(bucket < train, "train")
            .when(bucket < train + val, "val")
            .otherwise("test"))
