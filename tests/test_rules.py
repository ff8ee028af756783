"""Classification, debit/credit, sign and variance rules on hand-made rows."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.operators import controls as C
from ledgerloom.operators import enrich as E
from ledgerloom.operators import joins as JN
from ledgerloom.operators import match as M
from ledgerloom.operators import posting as P
from ledgerloom.operators import processor as R
from ledgerloom.sources import scans


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_txn_type_is_three_valued(spark):
    rows = [
        ("chargeback", "New", "A1", "REFUND"),
        ("Chargeback ", "New", "xManualTrans9", "CHARGEBACK"),
        ("chargeback", "New", None, "Rebill"),
        ("payment", "new", "A1", "NEW"),
        ("payment", "RENEW", None, "REBILL"),
        ("payment", None, "A1", "Rebill"),
        (None, "New", "A1", "Rebill"),
    ]
    df = spark.createDataFrame(rows, "transaction_type string, rebill string, txn_id string, want string")
    got = values(df.withColumn("got", S.txn_type("transaction_type", "rebill", "txn_id")), "got", "want")
    assert all(a == b for a, b in got), got


def test_business_line(spark):
    rows = [
        ("VPS", None, "payment", "1", "Hosting"),
        ("services", None, "payment", "1", "Professional Services"),
        ("addon", None, "payment", "1", "Add On"),
        ("Domain", None, "payment", "1", "Domain"),
        (None, None, "payment", "1234567890123456a ", "Cust Deposit"),
        (None, None, "payment", "12345678901234567", "Hosting"),
        (None, "PayU", "payment", "1234567890123456a", "Hosting"),
        (None, "PayU", "payment|cash deposit", "1", "Cust Deposit"),
        (None, "CREDIT", "payment", "1", "Cust Deposit"),
        ("unlisted", "Credit", "payment", "1", "Hosting"),
    ]
    df = spark.createDataFrame(rows, "g string, p string, t string, id string, want string")
    got = values(df.withColumn("got", S.business_line("g", "p", "t", "id")), "got", "want")
    assert all(a == b for a, b in got), got


def test_settled_by(spark):
    rows = [
        ("paypal", "1", "MXN", "Paypal"), ("DLOCAL", "1", "MXN", "Dlocal"), (None, "MANUALTRANS1", "MXN", "Dlocal"),
        ("Boleto", "1", "BRL", "Dlocal"), ("Boleto", "1", "MXN", "PayU"), ("Credit", "1", "USD", "Credit"),
        ("NULL", "1", "USD", "NULL"), (None, "1", "USD", None), (None, None, "MXN", None), ("Boleto", "1", None, "Boleto"),
    ]
    df = spark.createDataFrame(rows, "p string, id string, cur string, want string")
    got = values(df.withColumn("got", S.settled_by("p", "id", "cur")), "got", "want")
    assert all(a == b for a, b in got), got


def test_rules_agree_with_their_plain_form(spark):
    """Every pair of odd values, NULL, case and trailing blanks included, against the rules written out one by one."""
    processors = [None, "", "NULL", "null ", "credit", "Credit ", "PayPal", "dlocal ", "PayU", "x"]
    ids = [None, "", "manualTRANS1", "ABCDEFGHIJKLMNOPQ", "12345678901234567", "7"]
    texts = [None, "", "ChargeBack ", "payment|CASH deposit", "New", "renew ", "Renewal", "Shared ", "services", "ADDON", "other", "domain", "vps"]
    codes = [None, "", "mxn ", "MXN", "us", "United States ", "JPN", "in", "BR"]
    rows = spark.createDataFrame([(v,) for v in processors], "p string").join(spark.createDataFrame([(v,) for v in ids], "i string"))
    rows = rows.join(spark.createDataFrame([(v,) for v in texts], "t string")).join(spark.createDataFrame([(v,) for v in texts], "g string"))
    rows = rows.join(spark.createDataFrame([(v,) for v in codes], "c string"))
    k = {x: f"upper(rtrim({x}))" for x in "pitgc"}
    gst, ust = (", ".join(f"'{x.upper()}'" for x in v) for v in (S.GST_COUNTRIES, S.UST_COUNTRIES))
    dispute, manual = f"{k['t']} = 'CHARGEBACK'", "contains(upper(i), 'MANUALTRANS')"
    plain = {
        "txn_type": f"CASE WHEN {dispute} AND NOT {manual} THEN 'REFUND' WHEN {dispute} AND {manual} THEN 'CHARGEBACK' "
                    f"WHEN NOT {dispute} AND {k['g']} = 'NEW' THEN 'NEW' WHEN NOT {dispute} AND {k['g']} = 'RENEW' THEN 'REBILL' ELSE 'Rebill' END",
        "line": f"CASE WHEN {k['g']} IN ('DEDICATED', 'RESELLER', 'SHARED', 'VPS', 'BUILDER') THEN 'Hosting' WHEN {k['g']} = 'SERVICES' THEN 'Professional Services' "
                f"WHEN {k['g']} IN ('OTHER', 'ADDON') THEN 'Add On' WHEN {k['g']} = 'DOMAIN' THEN 'Domain' "
                "WHEN g IS NULL AND p IS NULL AND length(rtrim(i)) = 17 AND i RLIKE '(?i)[a-z]' THEN 'Cust Deposit' "
                f"WHEN g IS NULL AND {k['t']} = 'PAYMENT|CASH DEPOSIT' THEN 'Cust Deposit' WHEN g IS NULL AND {k['p']} = 'CREDIT' THEN 'Cust Deposit' ELSE 'Hosting' END",
        "settled": f"CASE WHEN {k['p']} = 'PAYPAL' THEN 'Paypal' WHEN {k['p']} = 'DLOCAL' OR {manual} THEN 'Dlocal' WHEN {k['p']} IS NULL OR {k['p']} IN ('NULL', 'CREDIT') THEN p "
                   f"WHEN {k['c']} = 'MXN' THEN 'PayU' WHEN NOT {k['c']} = 'MXN' THEN 'Dlocal' ELSE p END",
        "tax": f"CASE WHEN {k['c']} IN ({ust}) THEN 'UST' WHEN {k['c']} IN ({gst}) THEN 'GST' ELSE 'VAT' END",
    }
    own = {"txn_type": S.txn_type("t", "g", "i"), "line": S.business_line("g", "p", "t", "i"), "settled": S.settled_by("p", "i", "c"), "tax": S.tax_type("c")}
    wrong = rows.select("*", *[(~own[n].eqNullSafe(F.expr(sql))).alias(n) for n, sql in plain.items()])
    assert wrong.filter("txn_type OR line OR settled OR tax").head(3) == []


def test_business_day_cutoff(spark):
    rows = [
        ("Dlocal", "2021-01-04 20:59:59", dt.date(2021, 1, 4)),
        ("DLOCAL", "2021-01-04 21:00:00", dt.date(2021, 1, 5)),
        ("Paypal", "2021-01-04 23:59:59", dt.date(2021, 1, 4)),
        (None, "2021-01-04 10:00:00", None),
    ]
    df = spark.createDataFrame(rows, "settled_by string, t string, want date").withColumn("ts", F.col("t").cast("timestamp"))
    got = values(scans.scan_business_day(df), "business_date", "want")
    assert len(got) == 3 and all(a == b for a, b in got)
    one = scans.one_business_day(df, dt.date(2021, 1, 5))
    assert values(one, "t") == [("2021-01-04 21:00:00",)]


@pytest.mark.parametrize(
    "rule, expected",
    [
        ("CN", {"5": ("0.00", "5.00"), "-5": ("5.00", "0.00"), "0": ("0.00", "0.00"), None: (None, None)}),
        ("DN", {"5": ("5.00", "0.00"), "-5": ("0.00", "5.00"), "0": ("0.00", "0.00"), None: (None, None)}),
        ("DN0", {"5": ("5.00", "0.00"), "-5": ("0.00", "5.00"), "0": ("0.00", "0.00"), None: ("0.00", "0.00")}),
        ("CN0", {"5": ("0.00", "5.00"), "-5": ("5.00", "0.00"), "0": ("0.00", "0.00"), None: ("0.00", "0.00")}),
    ],
)
def test_debit_credit_rules(spark, rule, expected):
    df = spark.createDataFrame([(k,) for k in expected], "k string").withColumn("x", F.col("k").cast("decimal(15,3)"))
    for k, debit, credit in values(P.post(df, "x", rule), "k", "debit", "credit"):
        want = tuple(None if v is None else D(v) for v in expected[k])
        assert (debit, credit) == want


def test_money_rounds_half_away_from_zero(spark):
    df = spark.sql("SELECT CAST('2.345' AS DECIMAL(15,3)) AS x UNION ALL SELECT CAST('-2.345' AS DECIMAL(15,3))")
    assert sorted(values(P.post(df, "x", "DN"), "debit", "credit")) == [(D("0.00"), D("2.35")), (D("2.35"), D("0.00"))]


def test_mirror_balances(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 7.25), (2, -3.10) AS t(k, x)")
    got = P.post_mirrored(df, "x", "DN0", ["k"]).groupBy("k").agg((F.sum("debit") - F.sum("credit")).alias("d"))
    assert {d for _, d in values(got, "k", "d")} == {D("0.00")}


def test_event_codes(spark):
    rows = [
        ("T0006", "Paypal to Paypal Payment", "", "No"), ("t0200", "Currency Conversion", "X", "No"),
        ("T1106", "Reversal", "", "Yes"), ("T2103", "Reserves and Releases", "X", "No"), ("T9900", "<Undefined>", "", "No"),
        (None, "<Undefined>", "", "No"),
    ]
    df = spark.createDataFrame(rows, "code string, kind string, x string, cb string")
    got = df.select(R.event_type("code"), "kind", R.excluded_event("code"), "x", R.chargeback_event("code"), "cb").collect()
    assert all(r[0] == r[1] and r[2] == r[3] and r[4] == r[5] for r in got), got


def test_fx_default_and_exact_date(spark):
    ledger = spark.sql(
        "SELECT * FROM VALUES (1, 'mxn ', DATE'2021-01-04'), (2, 'MXN', DATE'2021-01-05'), (3, 'BRL', DATE'2021-01-04') AS t(k, currency, date)"
    )
    rates = spark.sql(
        "SELECT * FROM VALUES ('MXN', DATE'2021-01-04', 0.05), ('MXN', DATE'2021-01-04', 0.04) AS r(rate_currency, rate_date, rate)"
    )
    got = dict(values(E.enrich_fx(ledger, rates), "k", "fx_rate"))
    assert got == {1: D("0.05"), 2: D("1"), 3: D("1")}


def test_lookup_never_multiplies(spark):
    left = spark.range(10).withColumn("company", F.lit("A"))
    dim = spark.sql("SELECT * FROM VALUES ('a', '1'), ('A', '3'), ('A ', '2') AS d(k, v)")
    got = JN.left_lookup(left, dim, {"company": "k"}, "v", "none")
    assert values(got.groupBy("v").count(), "v", "count") == [("3", 10)]


DAY = "DATE'2021-01-04'"


def summaries(spark, ledger, processor):
    left = spark.sql(
        f"SELECT {DAY} AS ledger_business_date, 'C' AS ledger_company, * FROM VALUES {ledger} AS "
        "l(ledger_key, ledger_currency, ledger_flag, trans_local, trans_usd)"
    )
    right = spark.sql(
        f"SELECT {DAY} AS proc_business_date, 'C' AS proc_company, * FROM VALUES {processor} AS "
        "r(proc_key, proc_currency, proc_amount, proc_gross_usd, proc_net)"
    )
    return left, right


def test_hidden_fee_stages(spark):
    left, right = summaries(
        spark,
        "('1', 'MXN', 'N/A', 100.000, 5.000), ('2', 'BRL', 'N/A', 100.000, 20.000), ('3', 'MXN', 'CHARGEBACK', 50.000, 2.500), "
        "('4', 'COP', 'N/A', 10.000, 1.000), ('5', 'BRL', 'N/A', 7.000, 7.000)",
        "('1', 'MXN', 100.00, 4.60, 4.50), ('2', 'BRL', 100.00, 19.00, 18.00), ('3', 'MXN', 50.00, 2.40, 2.30), "
        "('4', 'COP', 11.00, 0.90, 0.80), ('9', 'CLP', 3.00, 3.00, 3.00)",
    )
    out = M.split_variance_hidden_fee(M.reconcile_flagged(left, right))
    rows = {(r.ledger_key, r.proc_key): r for r in out.collect()}
    # every ledger row and every report row appears; the chargeback never matches
    assert set(rows) == {("1", "1"), ("2", "2"), ("3", None), (None, "3"), ("4", "4"), ("5", None), (None, "9")}
    one = rows["1", "1"]
    assert (one.hidden_fee, one.fx_diff, one.other_diff) == (D("0.35"), D("0.05"), D("0.35"))
    # a currency without a fee rate has no split while local amounts agree
    two = rows["2", "2"]
    assert (two.hidden_fee, two.fx_diff, two.other_diff) == (None, None, None)
    assert (rows["4", "4"].hidden_fee, rows["4", "4"].fx_diff, rows["4", "4"].other_diff) == (D("0.00"), D("0.00"), D("0.10"))
    assert rows["3", None].other_diff == D("2.50") and rows[None, "9"].other_diff == D("-3.00")
    kept = {(r.ledger_key, r.proc_key) for r in M.exceptions(out, require_no_fx=True).collect()}
    assert kept == {("3", None), (None, "3"), ("4", "4"), ("5", None), (None, "9")}
    assert M.undecided(out).first().undecided == 1


def test_variance_parts_add_up(spark):
    left, right = summaries(
        spark, "('1', 'MXN', 'N/A', 100.000, 5.000), ('2', 'MXN', 'N/A', 9.000, 1.000)",
        "('1', 'MXN', 100.00, 4.90, 0.00), ('2', 'MXN', 8.00, 0.75, 0.00), ('7', 'MXN', 8.00, 0.75, 0.00)",
    )
    joined = M.reconcile(left, right).withColumn("event_code", F.when(F.col("proc_key") == "2", "T1106").otherwise("T0006"))
    rows = {r.proc_key: r for r in M.split_variance(joined, "event_code").collect()}
    assert (rows["1"].fx_diff, rows["1"].other_diff) == (D("0.10"), D("0.00"))
    assert (rows["2"].is_chargeback, rows["2"].chargeback_diff, rows["2"].total_diff) == ("Yes", D("0.25"), D("0.00"))
    assert rows["7"].other_diff == D("-0.75")
    assert all(r.total_diff == r.fx_diff + r.other_diff for r in rows.values())


def test_missing_ids_group_and_match(spark):
    """NULL and '' are two ledger groups shown as one id; both match an unidentified report row."""
    ledger = spark.sql(
        f"SELECT {DAY} AS business_date, {DAY} AS date, 'C' AS company, 'MXN' AS currency, 'NEW' AS txn_type, 'DLOCAL' AS settled_by, "
        "invoice_id, CAST(x AS DECIMAL(15,3)) AS trans_usd, CAST(x AS DECIMAL(15,3)) AS trans_local, "
        "CAST(x AS DECIMAL(15,3)) AS revenue_usd, CAST(x AS DECIMAL(15,3)) AS revenue_local "
        "FROM VALUES (NULL, 1), ('', 2), ('', 3), ('a', 4), ('A ', 5) AS t(invoice_id, x)"
    )
    left = R.summarise_ledger(ledger, "invoice_id", "Dlocal", "", chargeback_flag=True)
    assert sorted(values(left, "ledger_key", "trans_usd")) == [("", D("1.000")), ("", D("5.000")), ("A", D("9.000"))]
    report = spark.sql(
        f"SELECT {DAY} AS business_date, 'C' AS company, 'TX' AS row_type, CAST(NULL AS STRING) AS transaction_id, 'MXN' AS "
        "processing_currency, 1.00 AS signed_amount, 1.00 AS signed_net, 1.00 AS signed_gross"
    )
    joined = M.reconcile_flagged(left, R.summarise_sales_report(report))
    assert joined.filter("ledger_key IS NOT NULL AND proc_key IS NOT NULL").count() == 2


def test_exception_numbers_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(
        F.lit(dt.date(2021, 1, 4)).alias("business_date"),
        F.when(F.col("id") % 3 == 0, "B").otherwise("A").alias("company"),
        F.col("id").cast("string").alias("ledger_key"), F.lit(None).cast("string").alias("proc_key"),
    )
    from ledgerloom.operators.relational import row_identity

    one = row_identity(df, ["business_date", "company"], ["ledger_key", "proc_key"], "E-")
    two = row_identity(df.repartition(7), ["business_date", "company"], ["ledger_key", "proc_key"], "E-")
    shown = ["company", "ledger_key", "exception_num", "exception_id"]
    assert sorted(values(one, *shown)) == sorted(values(two, *shown))
    for company, n in (("A", 3333), ("B", 1667)):
        numbers = sorted(r[0] for r in values(one.filter(F.col("company") == company), "exception_num"))
        assert numbers == list(range(1, n + 1))


def test_gates(spark):
    lines = spark.sql(
        f"SELECT {DAY} AS business_date, 'C' AS company, journal, 'Operating' AS checkbookid, account, "
        "CAST(debit AS DECIMAL(15,2)) AS debit, CAST(credit AS DECIMAL(15,2)) AS credit FROM VALUES "
        "('a_sales', '061-11045-000', 3000, 0), ('a_sales', '061-40000-000', 0, 2940), ('wallet', '061-11045-000', 3000, 0), "
        "('wallet', '061-40000-000', 0, 3000), ('overpayment', '061-40000-000', 60, 0), ('card', '', 5, 5) "
        "AS t(journal, account, debit, credit)"
    )
    status = {r.journal: r.status for r in C.balance(lines).collect()}
    assert status == {"a_sales": "needs balancing", "wallet": "ok", "overpayment": "fail", "card": "ok"}
    assert {r.journal: r.status for r in C.balance(lines, C.EXCEPTION_BALANCE_LIMITS).collect()}["overpayment"] == "needs balancing"
    entry = C.balance_entries(lines, "061-11045-000").collect()
    assert [(r.journal, r.debit, r.credit) for r in entry] == [("a_sales", D("0.00"), D("60.00"))]
    assert C.placeholder_accounts(lines).first().value == 1
    # equal lines of two journals count once, unless told otherwise
    assert C.suspense_limit(lines, "061-11045-000").first().value == D("3000.00")
    assert C.suspense_limit(lines, "061-11045-000", dedupe=False).first().value == D("6000.00")
    days = spark.sql(f"SELECT {DAY} AS business_date, 'C' AS company")
    source = days.limit(0)
    gates = C.gate_results(lines, days, source, "061-11045-000")
    assert C.gate_status(gates).first().failed_gate == "balance"
    relaxed = C.gate_results(
        lines, days, source, "061-11045-000", C.EXCEPTION_BALANCE_LIMITS, {"placeholder", "completeness", "suspense"}
    )
    assert C.gate_status(relaxed).first().decision == "publish"
    assert C.gate_status(C.gate_results(lines, days, source, "061-11045-000", skip={"balance"})).first().failed_gate == "placeholder"
