"""Ledger enrichment: exchange rate, classification, amounts and inclusion flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.functions.keys import AMOUNT, ci_equals, zero_if_null
from ledgerloom.operators.joins import fx_lookup


def enrich_fx(ledger: DataFrame, rates: DataFrame) -> DataFrame:
    return fx_lookup(ledger, rates)


def classifications() -> dict[str, Column]:
    return {
        "txn_type": S.txn_type("transaction_type", "rebill_or_new", "txn_id"),
        "business_line": S.business_line("grouping", "processor", "transaction_type", "txn_id"),
        "settled_by": S.settled_by("processor", "txn_id", "currency"),
        "tax_type": S.tax_type("country"),
    }


def enrich_amounts(ledger: DataFrame) -> DataFrame:
    """Local and USD amounts, each rounded where the column is declared."""
    local = ledger.withColumns(
        {
            "trans_local": zero_if_null("total").cast(AMOUNT),
            "tax_local": zero_if_null("taxes").cast(AMOUNT),
        }
    )
    local = local.withColumn("revenue_local", (F.col("trans_local") - F.col("tax_local")).cast(AMOUNT))
    usd = {
        name.replace("_local", "_usd"): (F.col(name) * F.col("fx_rate")).cast(AMOUNT)
        for name in ("trans_local", "tax_local", "revenue_local")
    }
    return local.withColumns(usd)


def inclusion_flags() -> dict[str, Column]:
    deposit = ci_equals("business_line", S.DEPOSIT_LINE) & ~ci_equals("settled_by", S.CREDIT)
    return {
        "cash_included": F.when(ci_equals("settled_by", S.CREDIT), 0).otherwise(1),
        "gaap_included": F.when(deposit, 0).otherwise(1),
    }


def enrich_ledger(ledger: DataFrame, rates: DataFrame) -> DataFrame:
    """All enrichment rules: one lookup join, then projections that Spark collapses."""
    out = enrich_fx(ledger, rates).withColumns(classifications())
    return enrich_amounts(out).withColumns(inclusion_flags())


def flag_overpayment_prepaid(ledger: DataFrame) -> DataFrame:
    return ledger.withColumns(
        {
            "overpayment_flag": S.overpayment_flag("total", "invoice_total", "vat_tax"),
            "prepaid_flag": S.prepaid_flag("settled_by"),
        }
    )
