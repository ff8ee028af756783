"""Normalising payment-processor reports to one sign, one unit and the match grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import MONEY, PROCESSOR_RATE, ci_equals, ci_in, ci_key, zero_if_null
from ledgerloom.operators.aggregates import signed, sum_by
from ledgerloom.operators.joins import fx_lookup
from ledgerloom.sources.scans import cleared, file_date, scan_approved, scan_file_exact

# Event codes of the wallet statement.
EVENT_TYPES = {
    "T00": "Paypal to Paypal Payment",
    "T01": "Non-Payment Related Fees",
    "T02": "Currency Conversion",
    "T03": "Bank Deposit into Paypal Acct",
    "T04": "Bank Withdrawal from Paypal Acct",
    "T05": "Debit Card",
    "T06": "Credit Card Withdrawal",
    "T07": "Credit Card Deposit",
    "T08": "Bonus",
    "T09": "Incentive",
    "T11": "Reversal",
    "T12": "Adjustment",
    "T13": "Authorization",
    "T14": "Dividend",
    "T15": "Hold For Dispute",
    "T17": "Non-Bank Withdrawal",
    "T18": "Buyer Credit Withdrawal",
    "T19": "Account Correction",
    "T20": "Paypal to Paypal Funds Tfer",
    "T21": "Reserves and Releases",
}
UNDEFINED_EVENT = "<Undefined>"
EXCLUDED_PREFIXES = ["T02", "T04"]
EXCLUDED_CODES = [
    "T0000", "T0001", "T0104", "T0600", "T1105", "T1116", "T1503", "T2001", "T2103", "T2104", "T2105", "T2106",
]
CHARGEBACK_CODES = ["T1106", "T1110", "T1111", "T1114", "T1201", "T1202"]


# --- signs and units -------------------------------------------------------

def is_credit(type_column: str = "type") -> Column:
    return ci_equals(type_column, "CREDIT")


def sign_by_type(df: DataFrame, amounts: Mapping[str, str], type_column: str = "type") -> DataFrame:
    """Turn the sign of each amount on CREDIT rows; NULL stays NULL."""
    return df.withColumns(
        {name: F.when(is_credit(type_column), -F.col(c)).otherwise(F.col(c)).cast(MONEY) for name, c in amounts.items()}
    )


def sign_fee_inverse(df: DataFrame, fee: str, alias: str = "fee_signed", type_column: str = "type") -> DataFrame:
    """Fee as is on CREDIT rows, negated on all others."""
    return df.withColumn(alias, F.when(is_credit(type_column), F.col(fee)).otherwise(-F.col(fee)).cast(MONEY))


def sign_dispute_net(
    df: DataFrame, settlement: str, fee: str, alias: str = "net_usd", type_column: str = "type"
) -> DataFrame:
    """Disputed amount plus dispute fee, negative on CREDIT rows, NULL parts as zero."""
    net = zero_if_null(settlement) + zero_if_null(fee)
    return df.withColumn(alias, signed(is_credit(type_column), net).cast(MONEY))


def minor_to_major(amount: Column | str, debit_or_credit: Column | str) -> Column:
    """Minor units to money, negative for DR. Multiplies by 0.01 to stay decimal."""
    c = F.col(amount) if isinstance(amount, str) else amount
    major = (c.cast("decimal(15,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY)
    return F.when(ci_equals(debit_or_credit, "DR"), -major).otherwise(major)


def scale_minor_units(df: DataFrame, amounts: Mapping[str, str], debit_or_credit: str) -> DataFrame:
    return df.withColumns({name: minor_to_major(c, debit_or_credit) for name, c in amounts.items()})


# --- event codes and ids ---------------------------------------------------

def event_type(code: Column | str) -> Column:
    pairs = [x for k, v in EVENT_TYPES.items() for x in (F.lit(k), F.lit(v))]
    key = F.substring(ci_key(code), 1, 3)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(UNDEFINED_EVENT))


def excluded_event(code: Column | str) -> Column:
    key = ci_key(code)
    hit = F.substring(key, 1, 3).isin(*EXCLUDED_PREFIXES) | key.isin(*EXCLUDED_CODES)
    return F.when(hit, "X").otherwise("")


def chargeback_event(code: Column | str) -> Column:
    return F.when(ci_in(code, CHARGEBACK_CODES), "Yes").otherwise("No")


def coalesce_txn_id(*ids: str) -> Column:
    return F.coalesce(*[F.col(c) for c in ids], F.lit(""))


# --- report A: two row types in one file -----------------------------------

def route_row_types(df: DataFrame, row_type: str = "row_type") -> tuple[DataFrame, DataFrame]:
    """Transactions and chargebacks of one report."""
    return df.filter(ci_equals(row_type, "TX")), df.filter(ci_equals(row_type, "CB"))


def sales_report(report: DataFrame, bank_mid: str) -> DataFrame:
    """Report A for all business days, TX and CB rows side by side.

    The business date is the activity day; a row counts only when its file was
    delivered the day after. One pass serves both row types.
    """
    tx, cb = ci_equals("row_type", "TX"), ci_equals("row_type", "CB")
    active = F.when(tx, F.col("processing_date")).when(cb, F.col("cb_value_date"))
    rows = report.filter(ci_equals("bank_mid", bank_mid) & ((tx & cleared("status")) | cb))
    rows = rows.withColumn("business_date", F.to_date(active))
    rows = rows.filter(F.date_add("business_date", 1) == file_date("file_name"))
    rows = sign_by_type(
        rows,
        {
            "signed_amount": "processing_amount",
            "signed_gross": "gross_settlement_amount",
            "signed_net": "net_settlement_amount",
        },
    )
    rows = sign_fee_inverse(rows, "processing_fee_amount")
    return sign_dispute_net(rows, "dispute_settlement_amount", "dispute_fee", alias="dispute_net")


def settlement_report(report: DataFrame) -> DataFrame:
    """Settlement report for all run days: one signed net amount and the activity day of each row."""
    tx = ci_equals("row_type", "TX")
    rows = report.filter(ci_in("row_type", ["TX", "CB"]))
    rows = rows.withColumns(
        {
            "business_date": F.date_sub(file_date("file_name"), 1),
            "activity_date": F.to_date(F.when(tx, F.col("creation_date")).otherwise(F.col("dispute_registration_date"))),
            "match_id": F.when(tx, F.col("bank_reference")).otherwise(F.col("processor_reference")),
            "local_currency": F.when(tx, F.col("processing_currency")).otherwise(F.col("dispute_settlement_currency")),
        }
    )
    rows = sign_by_type(rows, {"tx_net": "net_settlement_amount"})
    return sign_dispute_net(rows, "dispute_settlement_amount", "dispute_fee", alias="cb_net")


# --- reports at match grain ------------------------------------------------

def wallet_report(report: DataFrame, rates: DataFrame) -> DataFrame:
    """Report B for all file dates: major units, exclusion flag, resolved id and rate."""
    rows = scan_file_exact(report)
    rows = fx_lookup(rows, rates, "gross_currency", "completion_date", "proc_rate", PROCESSOR_RATE)
    rows = scale_minor_units(rows, {"gross": "gross_minor", "fee": "fee_minor"}, "debit_or_credit")
    return rows.withColumns(
        {
            "proc_id": coalesce_txn_id("transaction_id", "reference_id"),
            "excluded": excluded_event("event_code"),
            "event_description": event_type("event_code"),
            "proc_date": F.to_date("initiation_date"),
        }
    )


def card_report(report: DataFrame, rates: DataFrame) -> DataFrame:
    """Report C for all update dates: approved rows with amount and rate."""
    rows = scan_approved(report, "update_date", "status")
    rows = fx_lookup(rows, rates, "transaction_currency", "creation_date", "proc_rate", PROCESSOR_RATE)
    return rows.withColumns(
        {
            "gross": F.col("processing_value").try_cast(MONEY),
            "proc_id": F.col("id"),
            "proc_date": F.to_date("creation_date"),
        }
    )


def summarise_processor(
    rows: DataFrame, id_column: str, currency: str, sums: Mapping[str, Column], extra: Sequence[str] = (),
    id_default: str | None = "",
) -> DataFrame:
    """A processor report at match grain.

    Rows are grouped by the id as delivered, and only then is a missing id
    shown as ``id_default``: a NULL and an empty id stay two groups.
    """
    keys = [
        "business_date",
        F.col("company").alias("proc_company"),
        ci_key(id_column).alias("proc_key"),
        ci_key(currency).alias("proc_currency"),
        *extra,
    ]
    out = sum_by(rows, keys, sums)
    if id_default is not None:
        out = out.withColumn("proc_key", F.coalesce("proc_key", F.lit(id_default)))
    return out.withColumnRenamed("business_date", "proc_business_date")


def summarise_sales_report(rows: DataFrame) -> DataFrame:
    tx = rows.filter(ci_equals("row_type", "TX"))
    sums = {
        "proc_amount": zero_if_null("signed_amount"),
        "proc_net": zero_if_null("signed_net"),
        "proc_gross_usd": zero_if_null("signed_gross"),
    }
    return summarise_processor(tx, "transaction_id", "processing_currency", sums)


def summarise_wallet_report(rows: DataFrame) -> DataFrame:
    kept = rows.filter(F.col("excluded") != "X")
    sums = {
        "proc_amount": F.col("gross"),
        "proc_fee_usd": zero_if_null("fee") * F.col("proc_rate"),
        "proc_gross_usd": F.col("gross") * F.col("proc_rate"),
    }
    extra = [ci_key("event_code").alias("event_code"), "proc_rate", "proc_date"]
    out = summarise_processor(kept, "proc_id", "gross_currency", sums, extra, id_default=None)
    return out.withColumn("proc_gross_usd", F.col("proc_gross_usd").cast(MONEY))


def summarise_card_report(rows: DataFrame) -> DataFrame:
    sums = {"proc_amount": F.col("gross"), "proc_gross_usd": F.col("gross") * F.col("proc_rate")}
    out = summarise_processor(
        rows, "proc_id", "transaction_currency", sums, ["proc_rate", "proc_date"], id_default=None
    )
    return out.withColumn("proc_gross_usd", F.col("proc_gross_usd").cast(MONEY))


def summarise_ledger(
    ledger: DataFrame, id_column: str, channel: str, id_default: str, chargeback_flag: bool = False
) -> DataFrame:
    """One channel of the ledger at match grain."""
    rows = ledger.filter(ci_equals("settled_by", channel))
    keys = [
        "business_date",
        F.col("company").alias("ledger_company"),
        ci_key(id_column).alias("ledger_key"),
        ci_key("currency").alias("ledger_currency"),
        F.to_date("date").alias("ledger_date"),
    ]
    if chargeback_flag:
        keys.append(F.when(ci_equals("txn_type", "CHARGEBACK"), "CHARGEBACK").otherwise("N/A").alias("ledger_flag"))
    out = sum_by(rows, keys, {m: m for m in ("trans_usd", "trans_local", "revenue_usd", "revenue_local")})
    out = out.withColumn("ledger_key", F.coalesce("ledger_key", F.lit(id_default)))
    return out.withColumnRenamed("business_date", "ledger_business_date")
