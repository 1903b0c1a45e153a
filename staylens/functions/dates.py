"""Stay dates such as ``December 2012``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names, January = 1.
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def stay_month(date_stayed: Column) -> Column:
    """Month 1 to 12 of the first word, null unless it is a full month name."""
    first_word = F.regexp_extract(date_stayed, r"^\s*(\S+)", 1)
    position = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), first_word)
    return F.nullif(position, F.lit(0)).cast("int")


def stay_year(date_stayed: Column) -> Column:
    """First run of four digits as a number, null when there is none."""
    return F.regexp_extract(date_stayed, r"(\d{4})", 1).try_cast("int")
