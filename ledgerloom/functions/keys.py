"""Keys and types shared by every operator.

Text is compared without case and without trailing blanks, so every equality,
join key and grouping key goes through :func:`ci_key`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
AMOUNT = T.DecimalType(15, 3)
LEDGER_RATE = T.DecimalType(15, 8)
PROCESSOR_RATE = T.DecimalType(10, 4)
FEE_RATE = T.DecimalType(10, 2)
# Row-level width of a stacked posting amount; its sum has ten more digits.
POSTING = T.DecimalType(20, 6)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ci_key(c: Column | str) -> Column:
    return F.upper(F.rtrim(col(c)))


def ci_equals(c: Column | str, value: str) -> Column:
    return ci_key(c) == F.lit(value.rstrip().upper())


def ci_in(c: Column | str, values: Iterable[str]) -> Column:
    return ci_key(c).isin(*[v.rstrip().upper() for v in values])


def ci_contains(c: Column | str, part: str) -> Column:
    return F.upper(col(c)).contains(part.upper())


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))
