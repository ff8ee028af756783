"""The star-schema tables in the roles of ledger, processor reports and dimensions.

The bindings give every row of ``orders`` and ``lineitem`` a role; attributes
the tables do not have (ids with gaps, mixed case, event codes) are derived
from the row's own key. Small dimensions are inline tables or a generated
calendar, so their size is known when the query is planned.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import LEDGER_RATE, MONEY, PROCESSOR_RATE, ci_equals
from ledgerloom.functions.scalars import CHANNEL_A, CREDIT, yyyymmdd
from ledgerloom.operators import enrich as E
from ledgerloom.operators import processor as R
from ledgerloom.operators.incremental import within_days
from ledgerloom.operators.relational import union
from ledgerloom.plans import journals as J
from ledgerloom.session import stage
from ledgerloom.sources.scans import scan_business_day, scan_date_range, statement_file_name
from ledgerloom.sources.tables import StarTables

# Inline dimensions.
RATE_BASES = [("MXN", "0.04871000"), ("COP", "0.00027000"), ("CLP", "0.00131000"), ("USD", "1.00000000")]
RATE_MARGIN_DAYS = 31  # rates are quoted this long before the first and after the last order, for reports dated apart from them
COMPANIES = ["LMX1", "LBR2"]
TYPES = ["CHARGEBACK", "NEW", "REBILL", "REFUND"]
LINES = ["Add On", "Cust Deposit", "Domain", "Hosting", "Professional Services"]
EVENT_CODES = [
    "T0006", "T0006", "T0007", "T1107", "T1106", "T1201", "T0200", "T0403", "T0001", "T1503", "T0300", "T9900",
]
# Processor by order priority 1 to 5, each for even and odd order keys.
PROCESSORS = ["Paypal", "PAYPAL", "Dlocal", "DLocal", "PayU", "PayU", None, None, "Credit", "Credit"]
GROUPINGS = {"BUILDING": "shared", "AUTOMOBILE": "addon", "MACHINERY": "domain", "FURNITURE": "services"}
TRANSACTION_TYPES = {"F": "payment", "O": "payment|cash deposit", "P": "chargeback"}
BANK_MID = "MID-A"
RUN_STAMP = "0101260930"
RUN_STAMP_LONG = "010120260930"
BRAND_TABLES = ["SRC_AFRICA", "SRC_AMERICA", "SRC_ASIA", "SRC_EUROPE", "SRC_MIDDLE_EAST"]
BRAND_MIDS = ["48500", "69100", "83700", "60700", "153400"]

# What journals, reports and the statement read of the enriched ledger, and the reports of the statement.
LEDGER_READ = (
    "order_key", "company", "date", "ts", "total", "invoice_total", "vat_tax", "currency", "processor", "invoice_id", "txn_id", "o_orderstatus",
    "fx_rate", "txn_type", "business_line", "settled_by", "tax_type", "trans_local", "revenue_local", "trans_usd", "tax_usd", "revenue_usd",
)
STATEMENT_READ = (
    "order_key", "company", "date", "ts", "gross", "currency", "processor", "settled_by", "invoice_id", "txn_id", "o_orderstatus", "fx_rate",
)


def matrix_rows() -> list[tuple[str, str, str, str]]:
    """Accounts by company, type and line: one combination missing, one present twice."""
    rows = []
    for company, segment in zip(COMPANIES, ("061", "042")):
        for t, kind in enumerate(TYPES):
            for n, line in enumerate(LINES):
                if (kind, line, company) != ("NEW", "Domain", "LMX1"):
                    head = "2" if line == "Cust Deposit" else "4"
                    rows.append((company, kind, line, f"{segment}-{head}{t}{n}00-000"))
    return [*rows, ("LMX1", "REFUND", "Hosting", "061-49900-000")]


def pick(values: list[str | None], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def pick_by(values: dict[str, str], key: str) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col(key))


def every(n: int, key: str = "order_key", rest: int = 0) -> Column:
    return F.col(key) % n == rest


class Roles(StarTables):
    # --- dimensions --------------------------------------------------------

    @cached_property
    def rate_days(self) -> tuple[dt.date | None, int]:
        """First day and number of days with rates: one row read once, so that no lookup scans the orders for it again."""
        first, last = self.orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
        if first is None:
            return None, 0
        return first - dt.timedelta(days=RATE_MARGIN_DAYS), (last - first).days + 1 + 2 * RATE_MARGIN_DAYS

    @cached_property
    def rates(self) -> DataFrame:
        """Daily rates by currency over the days of the orders; none on the 15th of a month, none for BRL."""
        n, (start, days) = len(RATE_BASES), self.rate_days
        day = F.date_add(F.lit(start).cast("date"), (F.col("id") / n).cast("int"))
        base = pick([b for _, b in RATE_BASES], F.col("id") % n).cast(LEDGER_RATE)
        drift = (F.lit(1) + F.dayofmonth("rate_date") * F.lit("0.001").cast("decimal(6,3)")).cast("decimal(6,3)")
        return (
            self.spark.range(days * n)
            .select(pick([c for c, _ in RATE_BASES], F.col("id") % n).alias("rate_currency"), day.alias("rate_date"),
                    base.alias("base"))
            .filter(F.dayofmonth("rate_date") != 15)
            .select("rate_currency", "rate_date", (F.col("base") * drift).cast(LEDGER_RATE).alias("rate"))
        )

    @cached_property
    def matrix(self) -> DataFrame:
        values = ", ".join(str(r) for r in matrix_rows())
        return self.spark.sql(
            f"SELECT * FROM VALUES {values} AS m(matrix_company, matrix_type, matrix_line, account_number)"
        )

    # --- ledger ------------------------------------------------------------

    @cached_property
    def ledger_raw(self) -> DataFrame:
        """``orders`` with customer and nation as the ledger before enrichment."""
        o = self.orders.select(
            F.col("o_orderkey").alias("order_key"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
            "o_orderpriority",
        )
        c = self.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        n = self.nation.select("n_nationkey", "n_regionkey")
        rows = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(n, F.col("c_nationkey") == F.col("n_nationkey"))

        key = F.col("order_key").cast("string")
        price = F.col("o_totalprice").cast(MONEY)
        manual = F.concat(F.lit("MANUALTRANS"), F.lpad(key, F.greatest(F.lit(6), F.length(key)), F.lit("0")))
        gap = F.when(every(97), F.lit(None)).when(every(89), F.lit(""))
        has_gap = every(97) | every(89)
        priority = F.left("o_orderpriority", F.lit(1))
        rows = rows.withColumns(
            {
                "company": F.when(every(4, rest=3), COMPANIES[1]).otherwise(COMPANIES[0]),
                "date": F.to_date("o_orderdate"),
                "ts": F.timestamp_add("HOUR", (F.col("order_key") % 24).cast("int"), F.col("o_orderdate")),
                "total": F.when(F.col("o_orderstatus") == "P", -price).otherwise(price).cast(MONEY),
                "currency": pick(["MXN", "COP", "CLP", "USD", "BRL"], F.col("n_regionkey")),
                "country": pick(["US", "India", "Japan", "MX", "BR"], F.col("n_nationkey") % 5),
                "processor": pick(PROCESSORS, (priority.cast("int") - 1) * 2 + F.col("order_key") % 2),
                "grouping": pick_by(GROUPINGS, "c_mktsegment"),
                "transaction_type": pick_by(TRANSACTION_TYPES, "o_orderstatus"),
                "rebill_or_new": F.when(every(3), "New").when(every(3, rest=1), "Renew"),
                "invoice_id": F.when(has_gap, gap).otherwise(key),
                "txn_id": F.when(has_gap, gap).when(every(10), manual).otherwise(key),
                "vat_tax": F.when(every(22), "1.50").otherwise("0"),
            }
        )
        tax_share = F.lit("0.16").cast("decimal(3,2)")
        rows = rows.withColumns(
            {
                "taxes": F.when(every(2), (F.col("total") * tax_share).cast(MONEY)),
                "invoice_total": F.when(every(11), F.col("total") - 5).otherwise(F.col("total")).cast(MONEY),
            }
        )
        return rows.select(
            "order_key", "company", "date", "ts", "total", "taxes", "invoice_total", "vat_tax", "currency", "country",
            "processor", "grouping", "transaction_type", "rebill_or_new", "invoice_id", "txn_id", "o_orderstatus",
        )

    @cached_property
    def ledger(self) -> DataFrame:
        return E.enrich_ledger(self.ledger_raw, self.rates)

    @cached_property
    def ledger_days(self) -> DataFrame:
        """The enriched ledger with its business date."""
        return scan_business_day(self.ledger)

    # --- processor reports -------------------------------------------------

    @cached_property
    def report_lines(self) -> DataFrame:
        """``lineitem`` as report A at line grain."""
        amount, share = F.col("l_extendedprice").cast(MONEY), F.col("l_discount").cast("decimal(4,2)")
        fee = (amount * share).cast(MONEY)
        key = F.col("l_orderkey").cast("string")
        return self.lineitem.select(
            F.col("l_orderkey").alias("order_key"),
            "l_linenumber",
            F.when(every(4, "l_orderkey", 3), COMPANIES[1]).otherwise(COMPANIES[0]).alias("company"),
            F.when(F.col("l_returnflag") == "R", "CREDIT").otherwise("DEBIT").alias("type"),
            F.when(F.col("l_linestatus") == "F", "TX").otherwise("CB").alias("row_type"),
            F.when(every(97, "l_orderkey"), F.lit(None)).otherwise(key).alias("transaction_id"),
            pick([c for c, _ in RATE_BASES], F.col("l_suppkey") % 4).alias("processing_currency"),
            amount.alias("processing_amount"),
            fee.alias("processing_fee_amount"),
            F.when(F.col("l_tax") > 0, amount - fee).cast(MONEY).alias("net_settlement_amount"),
            F.when(F.col("l_quantity") > 5, amount).cast(MONEY).alias("dispute_settlement_amount"),
            F.when(F.col("l_linenumber") > 2, F.lit("15.00").cast(MONEY)).alias("dispute_fee"),
            F.col("l_shipdate").alias("processing_date"),
            F.concat(yyyymmdd(F.date_add(F.to_date("l_shipdate"), 1)), F.lit("_settlement.csv")).alias("file_name"),
            F.when(every(31, "l_orderkey"), "rejected").when(every(4, "l_orderkey", 1), F.lit(None))
            .otherwise("Cleared").alias("status"),
            F.when(every(41, "l_orderkey"), "MID-Z").otherwise(BANK_MID).alias("bank_mid"),
        )

    @cached_property
    def statement(self) -> DataFrame:
        """One row per order with lines: what the processors' reports are made of."""
        lines = self.lineitem.groupBy(F.col("l_orderkey").alias("order_key")).agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).alias("line_total")
        )
        rows = self.ledger.select(
            "order_key", "company", "date", "ts", "total", "currency", "processor", "settled_by", "invoice_id", "txn_id",
            "o_orderstatus", "fx_rate",
        ).join(lines, "order_key")
        sign = F.when(F.col("total") < 0, -F.col("line_total")).otherwise(F.col("line_total"))
        return rows.withColumn("gross", F.when(every(5), sign).otherwise(F.col("total")).cast(MONEY))

    @cached_property
    def statement_a(self) -> DataFrame:
        """Report A: transactions and chargebacks, some delivered or dated late."""
        rows = self.statement.filter(ci_equals("settled_by", CHANNEL_A) | ci_equals("settled_by", CREDIT))
        day = F.to_date(F.timestamp_add("HOUR", F.lit(3), F.col("ts")))
        active = F.date_add(day, F.when(every(50), 1).otherwise(0))
        delivered = F.date_add(active, F.when(every(53), 2).otherwise(1))
        amount = F.abs("gross")
        usd = (amount * F.col("fx_rate").cast(PROCESSOR_RATE) * F.lit("0.93").cast("decimal(3,2)")).cast(MONEY)
        rows = rows.withColumns({"active": active.cast("timestamp"), "usd": usd})
        rows = rows.withColumn("fee", (F.col("usd") * F.lit("0.03").cast("decimal(3,2)")).cast(MONEY))
        return rows.select(
            "order_key", "company",
            F.concat(yyyymmdd(delivered), F.lit("_settlement.csv")).alias("file_name"),
            F.when((F.col("o_orderstatus") == "P") & every(3), "CB").otherwise("TX").alias("row_type"),
            F.when(every(31), "rejected").when(every(4, rest=1), F.lit(None)).otherwise("Cleared").alias("status"),
            F.when(every(41), "MID-Z").otherwise(BANK_MID).alias("bank_mid"),
            F.when(F.col("gross") < 0, "CREDIT").otherwise("DEBIT").alias("type"),
            F.col("invoice_id").alias("transaction_id"),
            F.col("invoice_id").alias("bank_reference"),
            F.col("txn_id").alias("processor_reference"),
            F.col("currency").alias("processing_currency"),
            F.lit("USD").alias("dispute_settlement_currency"),
            amount.cast(MONEY).alias("processing_amount"),
            F.col("usd").alias("gross_settlement_amount"),
            F.col("fee").alias("processing_fee_amount"),
            F.when(~every(101), F.col("usd") - F.col("fee")).cast(MONEY).alias("net_settlement_amount"),
            F.col("usd").alias("dispute_settlement_amount"),
            F.when(every(2), F.lit("15.00").cast(MONEY)).alias("dispute_fee"),
            F.col("active").alias("processing_date"),
            F.col("active").alias("cb_value_date"),
            F.to_date("active").alias("creation_date"),
            F.to_date("active").alias("dispute_registration_date"),
        )

    @cached_property
    def statement_b(self) -> DataFrame:
        """Report B: wallet statement in minor units."""
        rows = self.statement.filter(ci_equals("processor", "Paypal") | F.col("processor").isNull())
        minor = (F.abs("gross") * 100).cast("bigint")
        reference = F.when(every(97) & every(2), F.concat(F.lit("REF"), F.col("order_key").cast("string")))
        return rows.select(
            "order_key", "company",
            statement_file_name("date").alias("file_name"),
            F.when(every(13), "SF").otherwise("SB").alias("ch"),
            F.col("txn_id").alias("transaction_id"),
            reference.alias("reference_id"),
            pick(EVENT_CODES, F.col("order_key") % len(EVENT_CODES)).alias("event_code"),
            F.when(F.col("gross") < 0, "DR").otherwise("CR").alias("debit_or_credit"),
            minor.alias("gross_minor"),
            F.when(~every(19), F.floor(F.abs("gross") * 3).cast("bigint")).alias("fee_minor"),
            F.col("currency").alias("gross_currency"),
            F.col("ts").alias("initiation_date"),
            F.timestamp_add("DAY", F.lit(1), F.col("ts")).alias("completion_date"),
        )

    @cached_property
    def statement_c(self) -> DataFrame:
        """Report C: card report with amounts as text."""
        rows = self.statement.filter(ci_equals("processor", "PayU"))
        return rows.select(
            "order_key", "company",
            F.col("txn_id").alias("id"),
            F.when(every(17), "DECLINED").otherwise("APPROVED").alias("status"),
            F.col("ts").alias("update_date"),
            F.timestamp_add("DAY", F.lit(1), F.col("ts")).alias("creation_date"),
            F.col("gross").cast("string").alias("processing_value"),
            F.col("currency").alias("transaction_currency"),
        )

    # --- normalised and reconciled -----------------------------------------

    @cached_property
    def rows_a(self) -> DataFrame:
        return R.sales_report(self.statement_a, BANK_MID)

    @cached_property
    def rows_settlement(self) -> DataFrame:
        return R.settlement_report(self.statement_a)

    @cached_property
    def rows_b(self) -> DataFrame:
        return R.wallet_report(self.statement_b, self.rates)

    @cached_property
    def rows_c(self) -> DataFrame:
        return R.card_report(self.statement_c, self.rates)

    @cached_property
    def recon_a(self) -> DataFrame:
        return J.reconciled_a(self.ledger_days, self.rows_a)

    @cached_property
    def recon_b(self) -> DataFrame:
        return J.reconciled_b(self.ledger_days, self.rows_b)

    @cached_property
    def recon_c(self) -> DataFrame:
        return J.reconciled_c(self.ledger_days, self.rows_c)

    def for_days(self, first: dt.date, last: dt.date, lag_days: int) -> Roles:
        """The same roles for the business dates ``first`` to ``last`` only.

        ``lag_days`` is how many days a business date may lie after or before
        the order it reports on; the caller states it, as rows further apart
        are not read. Orders are cut to that wider range on the stored date,
        which the Parquet reader can use, lines to those orders before they
        are grouped; the exact cut is on the business date.
        """
        part = Roles(self.spark, self.data_dir)
        part.rates = self.rates
        near = dt.timedelta(days=lag_days)
        part.orders = scan_date_range(self.orders, "o_orderdate", between=(first - near, last + near))
        wanted = part.orders.select(F.col("o_orderkey").alias("l_orderkey"))
        part.lineitem = self.lineitem.join(wanted, "l_orderkey", "left_semi")
        for name in ("ledger_days", "rows_a", "rows_settlement", "rows_b", "rows_c"):
            setattr(part, name, within_days(getattr(part, name), first, last))
        return part

    @cached_property
    def staged(self) -> Roles:
        """The same roles, with what several journals read written once: the enriched ledger and the statement.

        Only the columns read from there are written, and what fills no column is not computed. The written frames last
        as long as the process.
        """
        part = Roles(self.spark, self.data_dir)
        part.rates, part.orders, part.lineitem = self.rates, self.orders, self.lineitem
        part.ledger = stage(self.ledger.select(*LEDGER_READ), "ledger")
        part.statement = stage(part.statement.select(*STATEMENT_READ), "statement")
        return part

    # --- journals ----------------------------------------------------------

    def journal(self, name: str) -> DataFrame:
        """One journal by name, planned on first use."""
        built = self.__dict__.setdefault("_journals", {})
        if name not in built:
            built[name] = {
                "a_cash": lambda: J.journal_cash(self.rows_settlement, RUN_STAMP_LONG),
                "wallet": lambda: J.journal_b(self.ledger_days, self.rows_b, self.matrix, RUN_STAMP),
                "a_sales": lambda: J.journal_a(self.ledger_days, self.rows_a, self.matrix),
                "card": lambda: J.journal_c(self.ledger_days, self.rows_c, self.matrix, RUN_STAMP),
                "overpayment": lambda: J.journal_overpayment(self.ledger_days, self.matrix),
            }[name]()
        return built[name]

    def tagged(self, *names: str) -> DataFrame:
        """Lines of the named journals with journal and merchant names."""
        return union(
            [
                self.journal(n).withColumns({"journal": F.lit(n), "merchant": F.lit(J.MERCHANT_TAGS[n])})
                for n in names
            ]
        )

    @cached_property
    def all_lines(self) -> DataFrame:
        return self.tagged(*J.MERCHANT_TAGS)
