"""Order-preserving bucket expressions. They turn a global order into many independent local ones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Above the largest |floor(per_octave * log2(x))| of any double, at 65,536 steps per octave.
_SHIFT = 1 << 28


def order_bucket(value: Column, per_octave: int) -> Column:
    """Monotone integer bucket of a double: ``per_octave`` steps for each doubling of the magnitude.

    A wide or heavy-tailed column is cut into pieces without knowing its range beforehand. Negative values mirror
    positive ones, and zero has its own bucket.
    """
    magnitude = F.floor(F.log2(F.abs(value)) * F.lit(float(per_octave))) + F.lit(_SHIFT)
    sign = F.signum(value).cast("long")
    endless = F.abs(value) == float("inf")
    return F.when(value == 0, F.lit(0).cast("long")).when(endless, sign * F.lit(2 * _SHIFT)).otherwise(sign * magnitude)


def linear_bucket(value: Column, low: Column, high: Column, parts: int | Column) -> Column:
    """Bucket 0..parts-1 of a value in [low, high]; the maximum falls in the last bucket. NULL without ``parts``."""
    count = (parts if isinstance(parts, Column) else F.lit(parts)).cast("long")
    share = F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0))
    return F.when(count.isNotNull(), F.least(F.floor(share * count), count - 1))


def keyed_hash(seed: int, *key: Column) -> Column:
    """Stable pseudo-random order of rows: the same row and seed give the same text on every run and partitioning.

    A key of several columns is written with the length of each value and a mark for NULL, so different keys stay apart.
    """
    parts = [k.cast("string") for k in key]
    if len(parts) > 1:
        parts = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
