"""The five journals, each built for all business days and companies at once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import MONEY, ci_equals, ci_in, ci_key, zero_if_null
from ledgerloom.functions.scalars import CHANNEL_A, CHANNEL_B, CHANNEL_C, CREDIT, DEPOSIT_LINE, yyyymmdd
from ledgerloom.operators import match as M
from ledgerloom.operators import posting as P
from ledgerloom.operators import processor as R
from ledgerloom.operators.aggregates import sum_by, sum_by_label
from ledgerloom.operators.joins import account_lookup, full_coalesce
from ledgerloom.operators.posting import JournalSpec, LineSpec
from ledgerloom.operators.relational import union

# Accounts, placeholders and label texts of the posted lines.
PLACEHOLDER = "XXX-XXXXX-XXX"
AR_ACCOUNT = "061-11001-000"
CASH_ACCOUNT = "061-10005-000"
FEE_ACCOUNT = "061-57000-590"
FX_ACCOUNT = "061-82700-950"
SUSPENSE_ACCOUNT = "061-11045-000"
CHARGEBACK_ACCOUNT = "061-11035-000"
TAX_ACCOUNTS_A = {"VAT": "042-24910-000", "IST": "042-24940-000", "GST": "042-24940-000", "UST": "042-21120-000"}
WALLET_ACCOUNTS = {
    "LMX1": {"cash": "042-10030-000", "VAT": "042-24910-000", "UST": "061-21120-000", "other": "061-24940-000"},
    "LBR2": {"cash": "061-10030-000", "VAT": "061-24910-000", "UST": "061-21120-000", "other": "061-24940-000"},
}
TAX_ACCOUNTS_C = {"VAT": "042-24910-000", "UST": "042-21120-000"}
TAX_OTHER_C = "042-24940-000"
MERCHANT_TAGS = {
    "a_cash": "DLOCAL CASH",
    "wallet": "Paypal",
    "a_sales": "DLOCAL",
    "card": "PayU",
    "overpayment": "Overpayment_JE",
}


@dataclass(frozen=True)
class Company:
    """Companies with accounts of their own; lines of any other get the placeholder."""

    known: tuple[str, ...] = ("LMX1",)

    def account(self, number: str) -> Column:
        return F.when(ci_in("company", self.known), F.lit(number)).otherwise(F.lit(PLACEHOLDER))

    def label(self, text: Column) -> Column:
        return F.when(ci_in("company", self.known), text).otherwise(F.lit("XXX - OTHER"))


def company_account(accounts: Mapping[str, Mapping[str, str]], kind: str) -> Column:
    """Account of a kind by company; the placeholder, which a gate stops, for a company without accounts."""
    table = F.create_map(*[F.lit(x) for company, own in accounts.items() for x in (company, own[kind])])
    return F.coalesce(F.try_element_at(table, ci_key("company")), F.lit(PLACEHOLDER))


def _tax_account(accounts: Mapping[str, str | Column], otherwise: str | Column) -> Column:
    out = None
    for kind, number in accounts.items():
        test, number = ci_equals("tax_type", kind), number if isinstance(number, Column) else F.lit(number)
        out = F.when(test, number) if out is None else out.when(test, number)
    return out.otherwise(otherwise)


def _text(*parts: str | Column) -> Column:
    """Concatenation in which one NULL part makes the whole label NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


c = F.col


# --- journal A: sales of the cut-off channel -------------------------------

def spec_a(companies: Company = Company()) -> JournalSpec:
    def tax_account() -> Column:
        known = _tax_account(TAX_ACCOUNTS_A, PLACEHOLDER)
        return F.when(ci_in("company", companies.known), known).otherwise(F.lit(PLACEHOLDER))

    def suspense_label() -> Column:
        dispute = c("flag") == "CHARGEBACK"
        return F.when(dispute, _text(c("company"), " CHARGEBACK SUSPENSE (DLOCAL)")).otherwise(
            _text(c("company"), " A/R SUSPENSE (DLOCAL)")
        )

    return JournalSpec(
        "a_sales", "Operating", " REVENUE DLOCAL", "DL", "",
        lines=(
            LineSpec(
                "revenue", "revenue_usd", ("txn_type", "business_line", "settled_by"), "CN",
                lambda: _text(
                    c("company"), " ", c("txn_type"), " ", c("business_line"), " - ", c("settled_by"), " SALES"
                ),
                matrix=("company", "txn_type", "business_line"),
            ),
            LineSpec(
                "tax", "tax_usd", ("settled_by", "tax_type"), "CN",
                lambda: _text(c("company"), " ", c("settled_by"), " - ", c("tax_type"), " PAYABLE"),
                account=tax_account, having=lambda: F.abs("amount") > 0,
            ),
            LineSpec(
                "fees", "fee_signed", (), "CN0",
                lambda: _text(c("company"), " - DLOCAL PROCESSING FEES"),
                account=lambda: companies.account(FEE_ACCOUNT),
                where=lambda: ci_equals("row_type", "TX") & (c("fee_signed") != 0),
            ),
            LineSpec(
                "fx_adjustment", "fx_diff", ("currency",), "DN",
                lambda: _text(c("company"), " (REALIZED (GAIN) LOSS) ", c("currency")),
                account=lambda: companies.account(FX_ACCOUNT), having=lambda: F.abs("amount") > 0,
            ),
            LineSpec(
                "hidden_fees", "hidden_fee", ("currency",), "DN",
                lambda: _text(c("company"), " Hidden Fees ", c("currency")),
                account=lambda: companies.account(FEE_ACCOUNT),
                where=lambda: F.abs("hidden_fee") != 0, uniqueid_prefix="DLF",
            ),
            LineSpec(
                "suspense", "other_diff", ("flag",), "DN", suspense_label,
                account=lambda: F.when(c("flag") == "CHARGEBACK", CHARGEBACK_ACCOUNT).otherwise(SUSPENSE_ACCOUNT),
                where=lambda: (c("fx_diff") == 0) & (c("other_diff") != 0),
            ),
            LineSpec(
                "chargebacks", "dispute_net", (), "CN0",
                lambda: _text(c("company"), " - CHARGEBACK SUSPENSE"),
                account=lambda: companies.account(CHARGEBACK_ACCOUNT),
                where=lambda: ci_equals("row_type", "CB"),
            ),
            LineSpec(
                "receivable", "receivable", (), "DN0",
                lambda: companies.label(_text(c("company"), " - ACCOUNTS RECEIVABLE (DLOCAL)")),
                account=lambda: F.lit(AR_ACCOUNT),
                where=lambda: ci_in("row_type", ["TX", "CB"]),
            ),
        ),
    )


def channel_slice(ledger: DataFrame, channel: str) -> DataFrame:
    """One channel of a ledger that already carries ``business_date``."""
    return ledger.filter(ci_equals("settled_by", channel))


def reconciled_a(ledger: DataFrame, report_rows: DataFrame) -> DataFrame:
    left = R.summarise_ledger(ledger, "invoice_id", CHANNEL_A, "", chargeback_flag=True)
    return M.split_variance_hidden_fee(M.reconcile_flagged(left, R.summarise_sales_report(report_rows)))


def joined_posting_view(joined: DataFrame) -> DataFrame:
    """Reconciled rows as the posting lines read them: processor currency and a filled flag."""
    return joined.withColumns({"currency": c("proc_currency"), "flag": F.coalesce("ledger_flag", F.lit("N/A"))})


def report_posting_view(rows: DataFrame) -> DataFrame:
    net = F.when(ci_equals("row_type", "TX"), zero_if_null("signed_net")).otherwise(c("dispute_net"))
    return rows.withColumn("receivable", net)


def journal_a(ledger: DataFrame, report_rows: DataFrame, matrix: DataFrame, companies: Company = Company()) -> DataFrame:
    """Lines from three frames, each summed in one pass."""
    spec = spec_a(companies)
    parts = [
        P.build_lines(channel_slice(ledger, CHANNEL_A), spec, spec.line("revenue", "tax"), matrix),
        P.build_lines(
            joined_posting_view(reconciled_a(ledger, report_rows)), spec,
            spec.line("fx_adjustment", "hidden_fees", "suspense"),
        ),
        P.build_lines(report_posting_view(report_rows), spec, spec.line("fees", "chargebacks", "receivable")),
    ]
    return finish_a(union(parts))


def finish_a(lines: DataFrame) -> DataFrame:
    receivable = F.upper("distref") == F.upper(_text(c("company"), " - ACCOUNTS RECEIVABLE (DLOCAL)"))
    out = P.add_document_amount(lines, receivable)
    return P.add_distribution_type(out, AR_ACCOUNT, "3", "9")


# --- journals B and C: wallet and card -------------------------------------

def spec_b(accounts: Mapping[str, Mapping[str, str]] = WALLET_ACCOUNTS) -> JournalSpec:
    taxes = {kind: company_account(accounts, kind) for kind in ("VAT", "UST")}
    return JournalSpec(
        "wallet", "PAYPAL", " CASH PAYPAL", "PP", PLACEHOLDER, repeat_date=True,
        lines=(
            LineSpec(
                "revenue", "revenue_usd", ("txn_type", "business_line", "currency"), "CN",
                lambda: _text(
                    c("company"), " ", c("txn_type"), " ", c("business_line"), " ", c("currency"), " - PAYPAL SALES"
                ),
                matrix=("company", "txn_type", "business_line"),
            ),
            LineSpec(
                "tax", "tax_usd", ("currency", "tax_type"), "CN",
                lambda: _text(c("company"), " PAYPAL ", c("currency"), " - ", c("tax_type"), " PAYABLE"),
                account=lambda: _tax_account(taxes, company_account(accounts, "other")), where=lambda: c("tax_usd") != 0,
            ),
            LineSpec(
                "suspense", "other_diff", ("currency",), "DN0",
                lambda: _text(c("company"), " PAYPAL ", c("currency"), " SUSPENSE - PAYPAL SALES"),
                account=lambda: F.lit(SUSPENSE_ACCOUNT), gated=True,
            ),
            LineSpec(
                "chargebacks", "chargeback_diff", ("currency",), "DN0",
                lambda: _text(c("company"), " CHARGEBACKS - PAYPAL ", c("currency"), " SALES"),
                account=lambda: F.lit(CHARGEBACK_ACCOUNT), where=lambda: c("is_chargeback") == "Yes",
            ),
            LineSpec(
                "fees", "proc_fee_usd", ("currency",), "DN0",
                lambda: _text(c("company"), " - PAYPAL ", c("currency"), " PROCESSING FEES"),
                account=lambda: F.lit(FEE_ACCOUNT), where=lambda: c("proc_fee_usd") != 0,
            ),
        ),
    )


def reconciled_b(ledger: DataFrame, report_rows: DataFrame) -> DataFrame:
    left = R.summarise_ledger(ledger, "txn_id", CHANNEL_B, "1")
    return M.split_variance(M.reconcile(left, R.summarise_wallet_report(report_rows)), "event_code")


def journal_b(
    ledger: DataFrame, report_rows: DataFrame, matrix: DataFrame, run_stamp: str,
    accounts: Mapping[str, Mapping[str, str]] = WALLET_ACCOUNTS,
) -> DataFrame:
    """The wallet journal; ``accounts`` holds each company's own cash and tax accounts."""
    spec, cash_account = spec_b(accounts), company_account(accounts, "cash")
    lines = union(
        [
            P.build_lines(channel_slice(ledger, CHANNEL_B), spec, spec.line("revenue", "tax"), matrix),
            P.build_lines(
                reconciled_b(ledger, report_rows), spec, spec.line("suspense", "chargebacks", "fees")
            ),
        ]
    )
    full = P.add_plug(lines, spec, cash_account, " CASH USD - PAYPAL SALES", "cash")
    cash = F.upper("distref").startswith(F.upper(_text(c("company"), " CASH")))
    out = P.add_document_amount(full, cash)
    out = P.add_distribution_type(out, cash_account, "1", "3")
    return P.add_receipt(out, _text(c("company"), "PPCR"), run_stamp)


def spec_c() -> JournalSpec:
    return JournalSpec(
        "card", "PAYU", " SALES PAYU", "PU", PLACEHOLDER, repeat_date=True,
        lines=(
            LineSpec(
                "revenue", "revenue_usd", ("txn_type", "business_line", "currency"), "CN",
                lambda: _text(
                    c("company"), " ", c("txn_type"), " ", c("business_line"), " ", c("currency"), " - PAYU SALES"
                ),
                matrix=("company", "txn_type", "business_line"),
            ),
            LineSpec(
                "tax", "tax_usd", ("currency", "tax_type"), "CN",
                lambda: _text(c("company"), " PAYU ", c("currency"), " - ", c("tax_type"), " PAYABLE"),
                account=lambda: _tax_account(TAX_ACCOUNTS_C, TAX_OTHER_C), where=lambda: c("tax_usd") != 0,
            ),
            LineSpec(
                "suspense", "other_diff", ("currency",), "DN0",
                lambda: _text(c("company"), " PAYU ", c("currency"), " SUSPENSE - PAYU SALES"),
                account=lambda: F.lit(SUSPENSE_ACCOUNT), gated=True,
            ),
        ),
    )


def reconciled_c(ledger: DataFrame, report_rows: DataFrame) -> DataFrame:
    left = R.summarise_ledger(ledger, "txn_id", CHANNEL_C, "1")
    return M.split_variance(M.reconcile(left, R.summarise_card_report(report_rows)))


def journal_c(ledger: DataFrame, report_rows: DataFrame, matrix: DataFrame, run_stamp: str) -> DataFrame:
    spec = spec_c()
    lines = union(
        [
            P.build_lines(channel_slice(ledger, CHANNEL_C), spec, spec.line("revenue", "tax"), matrix),
            P.build_lines(reconciled_c(ledger, report_rows), spec, spec.line("suspense")),
        ]
    )
    full = P.add_plug(lines, spec, AR_ACCOUNT, " A/R (USD) - PAYU SALES", "receivable")
    receivable = F.upper("distref").startswith(F.upper(_text(c("company"), " A/R")))
    out = P.add_document_amount(full, receivable)
    out = P.add_distribution_type(out, AR_ACCOUNT, "3", "9")
    return P.add_receipt(out, _text(c("company"), "PUCR"), run_stamp)


# --- settlement cash -------------------------------------------------------

def settlement_summary(settlement_rows: DataFrame) -> DataFrame:
    """Net settled and net disputed per run day, company and activity day, merged by full join."""
    dated = settlement_rows.filter(c("activity_date").isNotNull())
    tx, cb = R.route_row_types(dated)
    keys = ["business_date", "company", "activity_date"]
    settled = sum_by(tx, keys, {"settled": "tx_net"})
    disputed = sum_by(cb, keys, {"disputed": "cb_net"})
    merged = full_coalesce(settled, disputed, keys, ["settled", "disputed"])
    return merged.withColumn("net", (c("settled") + c("disputed")).cast(MONEY))


CASH_SPEC = JournalSpec("a_cash", "Operating", " CASH DLOCAL", "DL", PLACEHOLDER)


def journal_cash(settlement_rows: DataFrame, run_stamp: str) -> DataFrame:
    """Cash line and its mirrored receivable line per company and activity day."""
    both = P.post_mirrored(
        settlement_summary(settlement_rows), "net", "DN0", ["business_date", "company", "activity_date"]
    )
    own = c("side") == "line"
    lines = both.withColumns(
        {
            **P.header(CASH_SPEC),
            "account": F.when(own, CASH_ACCOUNT).otherwise(AR_ACCOUNT),
            "distref": _text(c("company"), F.when(own, " - CASH").otherwise(" - ACCOUNTS RECEIVABLE")),
            "uniqueid": _text(c("company"), "DL", yyyymmdd("activity_date")),
            "table_name": F.when(own, "cash").otherwise("receivable"),
        }
    ).select(*P.LINE_COLUMNS)
    cash = F.upper("distref") == F.upper(_text(c("company"), " - CASH"))
    out = P.add_document_amount(lines, cash)
    out = P.add_distribution_type(out, CASH_ACCOUNT, "1", "3")
    return P.add_receipt(out, F.lit("DCM"), run_stamp)


# --- overpayments ----------------------------------------------------------

OVERPAYMENT_SPEC = JournalSpec("overpayment", "Operating", " REVENUE", "OP", "")


def overpaid(ledger: DataFrame) -> DataFrame:
    over = zero_if_null("total") - zero_if_null("invoice_total") - zero_if_null(c("vat_tax").try_cast(MONEY))
    rows = ledger.filter(c("total") > c("invoice_total"))
    rows = rows.withColumns(
        {"overpayment": over.cast(MONEY), "overpayment_usd": (over * zero_if_null("fx_rate")).cast(MONEY)}
    )
    return rows.filter(~ci_equals("settled_by", CREDIT) & (c("overpayment_usd") != 0))


def journal_overpayment(ledger: DataFrame, matrix: DataFrame) -> DataFrame:
    """Sales line and mirrored prepaid-deposit line per company, type and product line."""
    sums = sum_by_label(
        overpaid(ledger), ["business_date", "company"], ["txn_type", "business_line"], {"amount": "overpayment_usd"}
    )
    sums = account_lookup(sums, matrix, default="", alias="sales_account")
    sums = account_lookup(
        sums, matrix, on=("company",), constant_line=DEPOSIT_LINE, default="", alias="deposit_account"
    )
    keep = ["business_date", "company", "txn_type", "business_line", "sales_account", "deposit_account"]
    both = P.post_mirrored(sums, "amount", "DN", keep)
    own = c("side") == "line"
    lines = both.withColumns(
        {
            **P.header(OVERPAYMENT_SPEC),
            "account": F.when(own, c("sales_account")).otherwise(c("deposit_account")),
            "distref": F.when(
                own, _text(c("company"), " ", c("txn_type"), " ", c("business_line"), " -  SALES")
            ).otherwise(_text(c("company"), " Prepaid Deposit")),
            "uniqueid": P.unique_id("OP", False),
            "table_name": F.lit("overpayment"),
        }
    ).select(*P.LINE_COLUMNS)
    out = lines.withColumn(
        "docamt", F.sum("debit").over(P.Window.partitionBy("business_date", "company")).cast(MONEY)
    )
    return out.withColumn("distype", F.lit("9"))
