"""Scalar helpers, all built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.keys import MONEY, ci_contains, ci_equals, ci_key, col


def first_non_null(*columns: Column | str) -> Column:
    return F.coalesce(*[col(c) for c in columns])


def visible_length(c: Column | str) -> Column:
    """Length that ignores trailing blanks."""
    return F.length(F.rtrim(col(c)))


def has_letter(c: Column | str) -> Column:
    return col(c).rlike("(?i)[a-z]")


def mmddyyyy(d: Column | str) -> Column:
    return F.date_format(col(d), "MMddyyyy")


def yyyymmdd(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyyMMdd")


def swap_date_halves(s: Column | str) -> Column:
    """``MMddyyyy`` text to ``yyyyMMdd`` text, and the reverse."""
    return F.concat(F.right(col(s), F.lit(4)), F.left(col(s), F.lit(4)))


def batch_id(d: Column | str, prefix: str = "ACL_") -> Column:
    return F.concat(F.lit(prefix), mmddyyyy(d))


def date_from_yyyymmdd(s: Column | str) -> Column:
    """NULL for text that is no such date, so that one odd file name stops no scan."""
    return F.try_to_date(col(s), "yyyyMMdd")


def business_date(ts: Column | str, channel: Column | str, cutoff_channel: str, cutoff_hour: int = 21) -> Column:
    """Day a transaction belongs to.

    The cut-off channel closes at ``cutoff_hour``; every other channel uses the
    calendar day. Rows of no channel belong to no day; the scans drop them.
    """
    ts = col(ts)
    shift = F.when(ci_equals(channel, cutoff_channel), 24 - cutoff_hour).otherwise(0)
    return F.to_date(F.timestamp_add("HOUR", shift, ts))


# --- ledger classification -------------------------------------------------

# Labels and code lists of the classification rules.
MANUAL_MARK = "MANUALTRANS"
HOSTING_GROUPS = ["dedicated", "reseller", "shared", "vps", "builder"]
ADD_ON_GROUPS = ["other", "addon"]
GROUP_LINES = {
    **{g.upper(): "Hosting" for g in HOSTING_GROUPS}, "SERVICES": "Professional Services",
    **{g.upper(): "Add On" for g in ADD_ON_GROUPS}, "DOMAIN": "Domain",
}
REBILL_TYPES = {"NEW": "NEW", "RENEW": "REBILL"}
DEPOSIT_TXN = "payment|cash deposit"
DEPOSIT_LINE = "Cust Deposit"
UST_COUNTRIES = ["US", "United States"]
GST_COUNTRIES = [
    "AU", "AUS", "Australia", "IN", "IND", "India", "JP", "JPN", "Japan", "NZ", "NZL", "New Zealand",
    "NO", "NOR", "Norway", "RU", "RUS", "Russian Federation", "CH", "CHE", "Switzerland", "TW", "TWN", "Taiwan",
]
TAX_COUNTRIES = {**{x.upper(): "GST" for x in GST_COUNTRIES}, **{x.upper(): "UST" for x in UST_COUNTRIES}}
CHANNEL_A = "Dlocal"
CHANNEL_B = "Paypal"
CHANNEL_C = "PayU"
CREDIT = "Credit"


def text_map(values: Mapping[str, str]) -> Column:
    """A constant map: a key looked up in it is computed once, not once per rule."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def txn_type(transaction_type: Column | str, rebill: Column | str, txn_id: Column | str) -> Column:
    dispute = ci_equals(transaction_type, "chargeback")
    manual = ci_contains(txn_id, MANUAL_MARK)
    disputed = F.when(~manual, "REFUND").when(manual, "CHARGEBACK").otherwise("Rebill")
    billed = F.coalesce(F.try_element_at(text_map(REBILL_TYPES), ci_key(rebill)), F.lit("Rebill"))
    return F.when(dispute, disputed).when(~dispute, billed).otherwise("Rebill")


def business_line(
    grouping: Column | str, processor: Column | str, transaction_type: Column | str, txn_id: Column | str
) -> Column:
    ungrouped = col(grouping).isNull()
    known = F.try_element_at(text_map(GROUP_LINES), ci_key(grouping))
    by_id = col(processor).isNull() & (visible_length(txn_id) == 17) & has_letter(txn_id)
    paid_in = by_id | ci_equals(transaction_type, DEPOSIT_TXN) | ci_equals(processor, CREDIT)
    return F.coalesce(known, F.when(ungrouped & paid_in, DEPOSIT_LINE).otherwise("Hosting"))


def settled_by(
    processor: Column | str, txn_id: Column | str, currency: Column | str, home_currency: str = "MXN"
) -> Column:
    """Settlement channel.

    The processor is tested once per value class, so the expression stays small
    where a filter on the channel is pushed through it.
    """
    key, home = ci_key(processor), ci_equals(currency, home_currency)
    return (
        F.when(key == CHANNEL_B.upper(), CHANNEL_B)
        .when((key == CHANNEL_A.upper()) | ci_contains(txn_id, MANUAL_MARK), CHANNEL_A)
        .when(col(processor).isNull() | key.isin("NULL", CREDIT.upper()), col(processor))
        .when(home, CHANNEL_C)
        .when(col(currency).isNotNull(), CHANNEL_A)
        .otherwise(col(processor))
    )


def tax_type(country: Column | str) -> Column:
    return F.coalesce(F.try_element_at(text_map(TAX_COUNTRIES), ci_key(country)), F.lit("VAT"))


def overpayment_flag(total: Column | str, invoice: Column | str, vat: Column | str) -> Column:
    excess = col(total) - col(invoice) - col(vat).try_cast(MONEY)
    return F.when(excess > 0, "X").otherwise("")


def prepaid_flag(channel: Column | str) -> Column:
    return F.when(ci_equals(channel, CREDIT), "X").otherwise("")


