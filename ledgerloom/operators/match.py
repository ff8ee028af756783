"""Full outer reconciliation of ledger and processor summaries, and the variance split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import FEE_RATE, MONEY, zero_if_null
from ledgerloom.operators.joins import full_outer
from ledgerloom.operators.processor import chargeback_event
from ledgerloom.operators.relational import row_identity

MATCH_KEYS = [
    ("ledger_business_date", "proc_business_date"),
    ("ledger_company", "proc_company"),
    ("ledger_key", "proc_key"),
]

# Hidden fee rate by ledger currency; no other currency has one.
HIDDEN_FEE_RATES = {"COP": "0.10", "CLP": "0.09", "MXN": "0.07"}

# Share of the ledger's chargebacks that may match: only rows of this flag do.
NOT_A_CHARGEBACK = "N/A"


def reconcile(ledger: DataFrame, processor: DataFrame, condition: Column | None = None) -> DataFrame:
    """Match both summaries inside a business date and company.

    Both sides are already grouped, so even the default id that stands for all
    unidentified transactions is a handful of rows per day.
    """
    joined = full_outer(ledger, processor, MATCH_KEYS, condition)
    return joined.withColumns(
        {
            "business_date": F.coalesce("ledger_business_date", "proc_business_date"),
            "company": F.coalesce("ledger_company", "proc_company"),
            "currency": F.coalesce("ledger_currency", "proc_currency"),
        }
    ).drop("ledger_business_date", "proc_business_date")


def reconcile_flagged(ledger: DataFrame, processor: DataFrame) -> DataFrame:
    """As :func:`reconcile`, but ledger chargebacks always stay unmatched."""
    return reconcile(ledger, processor, F.col("ledger_flag") == NOT_A_CHARGEBACK)


def split_variance(df: DataFrame, event_code: str | None = None) -> DataFrame:
    """Total difference into chargeback, exchange-rate and other parts."""
    flag = chargeback_event(event_code) if event_code else F.lit("No")
    gap = (zero_if_null("trans_usd") - zero_if_null("proc_gross_usd")).cast(MONEY)
    ordinary = F.col("is_chargeback") == "No"
    same_local = F.col("trans_local") == F.col("proc_amount")
    return (
        df.withColumn("is_chargeback", flag)
        .withColumns(
            {
                "chargeback_diff": F.when(~ordinary, gap).otherwise(F.lit(0)).cast(MONEY),
                "total_diff": F.when(ordinary, gap).otherwise(F.lit(0)).cast(MONEY),
                "fx_diff": F.when(same_local & ordinary, gap).otherwise(F.lit(0)).cast(MONEY),
            }
        )
        .withColumn("other_diff", (F.col("total_diff") - F.col("fx_diff")).cast(MONEY))
    )


def hidden_fee_rate(currency: Column | str) -> Column:
    rate = None
    for code, value in HIDDEN_FEE_RATES.items():
        test = F.col(currency) == code if isinstance(currency, str) else currency == code
        rate = F.when(test, F.lit(value)) if rate is None else rate.when(test, F.lit(value))
    return rate.cast(FEE_RATE)


def split_variance_hidden_fee(df: DataFrame) -> DataFrame:
    """Variance split net of the hidden fee.

    Two stages on purpose: the hidden fee looks at the amounts as joined, the
    exchange-rate part at the amounts after missing ones became zero. A ledger
    currency without a fee rate gives NULL, not zero, in both.
    """
    same_local = F.col("trans_local") == F.col("proc_amount")
    first = df.withColumn("hidden_fee_rate", hidden_fee_rate("ledger_currency"))
    first = first.withColumn(
        "hidden_fee",
        F.when(same_local, F.col("trans_usd") * F.col("hidden_fee_rate")).otherwise(F.lit(0)).cast(MONEY),
    )
    filled = first.withColumns(
        {m: zero_if_null(m) for m in ("trans_usd", "trans_local", "proc_net", "proc_gross_usd", "proc_amount")}
    )
    fx = F.col("trans_usd") * (F.lit(1).cast(FEE_RATE) - F.col("hidden_fee_rate")) - F.col("proc_gross_usd")
    second = filled.withColumns(
        {
            "total_diff": (F.col("trans_usd") - F.col("proc_gross_usd")).cast(MONEY),
            "fx_diff": F.when(same_local, fx).otherwise(F.lit(0)).cast(MONEY),
        }
    )
    return second.withColumns(
        {
            "abs_diff": F.abs("total_diff"),
            "other_diff": (F.col("total_diff") - F.col("fx_diff")).cast(MONEY),
        }
    )


def undecided(df: DataFrame) -> DataFrame:
    """Per day and company, rows whose split is NULL: in neither the rate part nor the exceptions."""
    by_day = df.groupBy("business_date", "company")
    return by_day.agg(F.count(F.when(F.col("other_diff").isNull(), 1)).alias("undecided"), F.count("*").alias("n"))


def exceptions(df: DataFrame, require_no_fx: bool = False) -> DataFrame:
    out = df.filter(F.col("other_diff") != 0)
    return out.filter(F.col("fx_diff") == 0) if require_no_fx else out


EXCEPTION_COLUMNS = [
    "business_date", "company", "ledger_key", "proc_key", "ledger_currency", "proc_currency", "ledger_date", "fx_diff",
    "other_diff",
]


def number_exceptions(df: DataFrame, label: str, require_no_fx: bool = False) -> DataFrame:
    """Exceptions numbered inside a business date and company, in the order of their own columns; others are carried along."""
    rows = exceptions(df, require_no_fx)
    return row_identity(rows, ["business_date", "company"], ["ledger_key", "proc_key"], label, order=EXCEPTION_COLUMNS)


def numbered_exceptions(df: DataFrame, label: str, require_no_fx: bool = False) -> DataFrame:
    return number_exceptions(df.select(*EXCEPTION_COLUMNS), label, require_no_fx)


def match_status(ledger_key: str = "ledger_key", proc_key: str = "proc_key") -> Column:
    return (
        F.when(F.col(ledger_key).isNull(), "processor only")
        .when(F.col(proc_key).isNull(), "ledger only")
        .otherwise("matched")
    )
