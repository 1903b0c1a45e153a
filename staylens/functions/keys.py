"""Row-wise hashes of a key: layout-independent splits and draws.

Which part a row falls into depends on its key alone, so a retried task, another
partitioning or a second pass gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prime modulus, multiplier and offset of the portable hash.
_MODULUS, _MULTIPLIER, _OFFSET = 1_000_003, 7_919, 104_729


def hash_bucket(key: Column, buckets: int, draw: Column | int = 0) -> Column:
    """Bucket 0 to ``buckets - 1`` of any key, well mixed; ``draw`` numbers repeats."""
    return F.pmod(F.xxhash64(key, _column(draw)), F.lit(buckets))


def arithmetic_bucket(key: Column, buckets: int, draw: Column | int = 0) -> Column:
    """Bucket of an integer key by plain arithmetic, which any SQL engine can repeat; null counts as 0."""
    return (F.pmod(F.coalesce(key, F.lit(0)), F.lit(_MODULUS)) * _MULTIPLIER + _OFFSET * (_column(draw) + 1)) % buckets


def arithmetic_bucket_sql(key: str, buckets: int) -> str:
    """``arithmetic_bucket`` of the first draw as SQL text."""
    return f"(((coalesce({key}, 0) % {_MODULUS}) * {_MULTIPLIER} + {_OFFSET}) % {buckets})"


def _column(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("long")
