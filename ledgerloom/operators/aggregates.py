"""Grouped aggregates.

Sums, counts and dates have fixed-width buffers, so Spark uses hash
aggregation with a map-side combine. Text never sits in an aggregate buffer
over the large input: labels are grouping keys first, and only the small
grouped result is merged once more by case-insensitive key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import ci_key


def sum_by(df: DataFrame, keys: Sequence[Column | str], sums: Mapping[str, Column | str]) -> DataFrame:
    measures = [F.sum(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in sums.items()]
    return df.groupBy(*keys).agg(*measures) if keys else df.agg(*measures)


def sum_by_label(
    df: DataFrame, keys: Sequence[str], labels: Sequence[str], sums: Mapping[str, Column | str]
) -> DataFrame:
    """Sum by exact ``keys`` and case-insensitive ``labels``; the largest spelling is shown."""
    exact = sum_by(df, [*keys, *labels], sums)
    by = [*keys, *[ci_key(c).alias(f"__{c}") for c in labels]]
    merged = exact.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in labels], *[F.sum(m).alias(m) for m in sums]
    )
    return merged.select(*keys, *labels, *sums)


def signed(flag: Column, amount: Column) -> Column:
    """``amount`` with its sign turned where ``flag`` holds; NULL counts as zero."""
    amount = F.coalesce(amount, F.lit(0))
    return F.when(flag, -amount).otherwise(amount)


def sum_signed(df: DataFrame, keys: Sequence[Column | str], flag: Column, measures: Mapping[str, str]) -> DataFrame:
    return sum_by(df, keys, {name: signed(flag, F.col(c)) for name, c in measures.items()})


def count_and_max(df: DataFrame, keys: Sequence[str], date: str, n: str = "n", latest: str = "latest") -> DataFrame:
    measures = [F.count("*").alias(n), F.max(date).alias(latest)]
    return df.groupBy(*keys).agg(*measures) if keys else df.agg(*measures)


def count_filtered(df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count(F.when(c, 1)).alias(name) for name, c in counts.items()])


def debit_credit_totals(df: DataFrame, keys: Sequence[str], prefix: str | None = None) -> DataFrame:
    """Debit and credit totals, optionally of lines whose label starts with a prefix, and their difference."""
    lines = df if prefix is None else df.filter(F.upper("distref").startswith(prefix.upper()))
    out = lines.groupBy(*keys).agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
    return out.withColumn("docamt", F.col("debit") - F.col("credit"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def ordered_by_aggregate(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column | str], order: Column) -> DataFrame:
    return sum_by(df, keys, sums).orderBy(order, *keys)


def pivot_max(df: DataFrame, keys: Sequence[str], pivot: str, values: Mapping[str, str], measure: str) -> DataFrame:
    """Latest ``measure`` per key and listed pivot value, one column each.

    The value list is given, so no extra job runs to discover it.
    """
    out = df.groupBy(*keys).pivot(pivot, list(values)).agg(F.max(measure))
    return out.withColumnsRenamed(dict(values))
