"""Rows that must not get lost: missing keys, first runs, odd names and amounts, stale batches, oversized partitions."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom.operators import controls as C
from ledgerloom.operators import publish as P
from ledgerloom.operators.incremental import refresh_since_mark
from ledgerloom.operators.relational import row_identity
from ledgerloom.plans import daily_close as DC
from ledgerloom.plans import journals as J
from ledgerloom.session import scratch_path
from ledgerloom.sources import scans, sinks


def test_numbering_keeps_rows_without_company_or_date(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE '2021-01-05', 'A', 'x', 'y'), (DATE '2021-01-05', NULL, 'x', 'y'), (NULL, 'A', 'x', NULL) "
                   "AS t(business_date, company, ledger_key, proc_key)")
    out = row_identity(df, ["business_date", "company"], ["ledger_key", "proc_key"], "E-").collect()
    assert len(out) == 3 and {r.exception_num for r in out} == {1}
    assert out[0].asDict().keys() == {"business_date", "company", "ledger_key", "proc_key", "exception_num", "exception_id"}


@pytest.mark.parametrize("rows,fresh", [
    ("('a', TIMESTAMP'2021-01-01', NULL), ('b', NULL, NULL)", {"a", "b"}),
    ("('a', TIMESTAMP'2021-01-01', 1), ('b', TIMESTAMP'2021-01-02', NULL), ('c', NULL, NULL), ('d', TIMESTAMP'2020-01-01', NULL)", {"a", "b"}),
])
def test_increments_keep_every_row(spark, rows, fresh):
    table = spark.sql(f"SELECT id, created_at, CAST(fx_rate AS INT) AS fx_rate, 'old' AS run FROM VALUES {rows} AS t(id, created_at, fx_rate)")
    out = refresh_since_mark(table, lambda df: df.withColumn("run", F.lit("new"))).collect()
    assert len(out) == table.count() and {r.id for r in out if r.run == "new"} == fresh


def test_full_run_is_an_increment_from_an_empty_mark(spark):
    table = spark.sql("SELECT id, TIMESTAMP'2021-01-01' + make_dt_interval(CAST(id AS INT)) AS created_at, CAST(NULL AS INT) AS fx_rate FROM range(9)")
    def enrich(df):
        return df.withColumn("fx_rate", F.lit(1))
    assert sorted(refresh_since_mark(table, enrich).collect()) == sorted(enrich(table).collect())


def test_odd_file_names_stop_nothing_and_are_counted(spark):
    df = spark.sql("SELECT * FROM VALUES ('readme.txt', '1.5'), ('20210106_s.csv', 'abc'), (NULL, ''), ('20210106_t.csv', NULL) AS t(file_name, amount)")
    assert scans.scan_file_prefix(df).filter("business_date = DATE'2021-01-05'").count() == 2
    out = scans.rejected_rows(df, {"name": scans.file_date("file_name").isNull(), "amount": scans.is_no_amount("amount")})
    assert {r.reason: r.n for r in out.collect()} == {"name": 2, "amount": 1}


def test_ranges_equal_the_filtered_whole(spark):
    day = dt.date(2021, 1, 5)
    files = spark.sql("SELECT concat(date_format(DATE'2021-01-01' + CAST(id AS INT), 'yyyyMMdd'), '_x.csv') AS file_name FROM range(20)")
    whole = scans.scan_file_prefix(files).filter(F.col("business_date").between("2021-01-05", "2021-01-07"))
    assert sorted(scans.scan_file_prefix(files, days=(day, day + dt.timedelta(2))).collect()) == sorted(whole.collect())
    named = spark.sql("SELECT concat(IF(id % 2 = 0, 'STL-', 'stl-'), date_format(DATE'2021-01-01' + CAST(id AS INT), 'yyyyMMdd'), '.01.009.CSV') AS file_name, 'SB' AS ch FROM range(20)")
    exact = scans.scan_file_exact(named, days=(day, day + dt.timedelta(2)))
    assert exact.count() == 3
    events = spark.sql("SELECT TIMESTAMP'2021-01-03 20:30:00' + make_dt_interval(0, CAST(id AS INT)) AS ts, IF(id % 2 = 0, 'Dlocal', 'Other') AS settled_by FROM range(96)")
    days = scans.scan_business_day(events).filter(F.col("business_date").between("2021-01-05", "2021-01-06"))
    assert sorted(scans.scan_business_day(events, days=(day, dt.date(2021, 1, 6))).collect()) == sorted(days.collect())


def test_range_filters_reach_both_scans(spark, tmp_path):
    spark.sql("SELECT '20210106_a.csv' AS file_name, TIMESTAMP'2021-01-05' AS ts, 'x' AS settled_by").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    days = (dt.date(2021, 1, 5), dt.date(2021, 1, 5))
    for df, column in ((scans.scan_file_prefix(table, days=days), "file_name"), (scans.scan_business_day(table, days=days), "ts")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({column}" in plan and f"LessThan({column}" in plan


def test_a_late_report_is_read_when_the_lag_says_so(spark):
    from ledgerloom.sources.roles import Roles

    roles = Roles(spark, "/root/testdata/sf0.001")
    first = last = dt.date(1997, 3, 5)
    late = roles.orders.filter("CAST(o_orderdate AS DATE) = DATE'1997-03-05'").withColumn("o_orderdate", F.expr("o_orderdate - INTERVAL 9 DAY"))
    roles.orders = late
    assert roles.for_days(first, last, 4).orders.count() == 0
    assert roles.for_days(first, last, 9).orders.count() == late.count()


def test_completeness_is_per_company(spark):
    days = spark.sql("SELECT DATE'2021-01-05' AS business_date, company FROM VALUES ('A'), ('B') AS t(company)")
    out = C.source_completeness(days, days.filter("company = 'A'"))
    assert {r.company: r.status for r in out.collect()} == {"A": "ok", "B": "fail"}


def test_only_a_missing_path_counts_as_absent(spark, tmp_path):
    assert not sinks.table_exists(spark, f"{tmp_path}/nothing")
    with pytest.raises((AnalysisException, Exception)):
        sinks.table_exists(spark, "nosuchscheme://x/y")


def test_an_oversized_partition_gets_several_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 60_000, 1, 8).select(F.lit("2021-01").alias("m"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        sinks.append_history(df, f"{tmp_path}/h", "m STRING, x STRING", ["m"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if before is None else spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list(Path(f"{tmp_path}/h/m=2021-01").glob("part-*.parquet"))) > 1
    assert spark.read.parquet(f"{tmp_path}/h").count() == 60_000


def _lines(spark, days, bad=()):
    rows = ", ".join(
        f"(DATE'{d}', 'LMX1', 'Operating', 'ACL_{d[5:7]}{d[8:]}{d[:4]}', '{'' if d in bad else '061-40000-000'}', {v}, 0), "
        f"(DATE'{d}', 'LMX1', 'Operating', 'ACL_{d[5:7]}{d[8:]}{d[:4]}', '061-10005-000', 0, {v})" for d, v in days)
    lines = spark.sql(f"SELECT * FROM VALUES {rows} AS t(business_date, company, checkbookid, batchid, account, debit, credit)")
    wanted = [x.strip().split()[0] for x in DC.STAGED.replace("DECIMAL(15,2)", "DECIMAL").split(",")]
    lines = lines.withColumns({"journal": F.lit("a_sales"), "merchant": F.lit("m"), "distref": F.concat(F.lit("r"), "account")})
    return lines.withColumns({c: F.lit(None).cast("string") for c in wanted if c not in lines.columns})


def test_a_day_that_fails_on_rerun_leaves_no_stale_line(spark):
    days = spark.sql("SELECT CAST(d AS DATE) AS business_date, 'LMX1' AS company FROM VALUES ('2021-01-05'), ('2021-02-06') AS t(d)")
    staging, common = scratch_path(spark, "staged"), scratch_path(spark, "common")
    good = _lines(spark, [("2021-01-05", 5), ("2021-02-06", 7)])
    DC.close_days(good, days, days, staging, common).collect()
    assert spark.read.schema(DC.COMMON).parquet(common).count() == 4
    bad = _lines(spark, [("2021-01-05", 5), ("2021-02-06", 7)], bad={"2021-02-06"})
    decisions = {str(r.business_date): r.decision for r in DC.close_days(bad, days, days, staging, common).collect()}
    assert decisions == {"2021-01-05": "publish", "2021-02-06": "stop"}
    assert {r.batchid for r in spark.read.schema(DC.COMMON).parquet(common).collect()} == {"ACL_01052021"}


def test_a_failed_middle_day_stays_pending_until_it_passes(spark):
    dates = ["2021-01-05", "2021-01-06", "2021-01-07"]
    days = spark.sql("SELECT CAST(d AS DATE) AS business_date, 'LMX1' AS company FROM VALUES ('2021-01-05'), ('2021-01-06'), ('2021-01-07') AS t(d)")
    history = spark.createDataFrame([], "run_id int, start_date timestamp, stop_date timestamp, date_run date, brand_table string")
    staging, common = scratch_path(spark, "staged"), scratch_path(spark, "common")
    now = F.lit("2021-01-09 00:00:00").cast("timestamp")
    _, rows = DC.close_pending(_lines(spark, [(d, 5) for d in dates], {"2021-01-06"}), days, days, history, staging, common, now, now)
    history = spark.createDataFrame(history.unionByName(rows).collect(), history.schema)
    assert [(r.run_id, str(r.date_run)) for r in sorted(history.collect())] == [(1, "2021-01-05"), (2, "2021-01-07")]
    assert [str(r.business_date) for r in P.pending_days(history, days).collect()] == ["2021-01-06"]
    _, rows = DC.close_pending(_lines(spark, [(d, 5) for d in dates]), days, days, history, staging, common, now, now)
    assert [(r.run_id, str(r.date_run)) for r in rows.collect()] == [(3, "2021-01-06")]
    assert spark.read.schema(DC.COMMON).parquet(common).select("batchid").distinct().count() == 3


def test_lines_without_company_are_reported(spark):
    lines = _lines(spark, [("2021-01-05", 5)]).withColumn("company", F.lit(None).cast("string"))
    assert DC.orphan_lines(lines).first().lines == 2


def test_wallet_accounts_are_each_companys_own(spark):
    df = spark.sql("SELECT * FROM VALUES ('LMX1'), ('lbr2'), ('OTHER'), (NULL) AS t(company)")
    got = [r[0] for r in df.select(J.company_account(J.WALLET_ACCOUNTS, "cash")).collect()]
    assert got == ["042-10030-000", "061-10030-000", J.PLACEHOLDER, J.PLACEHOLDER]


@pytest.mark.parametrize("head", ["STL-", "Statement-"])
def test_a_range_of_exact_files_keeps_heads_of_any_case(spark, head):
    names = [f"{h}{day}.01.009.csv" for h in (head, head.lower(), head.upper(), head.capitalize(), head.swapcase(), head[0].lower() + head[1:]) for day in ("19970304", "19970305", "19970306")]
    df = spark.createDataFrame([(n, "sb") for n in names], "file_name string, ch string")
    day = dt.date(1997, 3, 5)
    ranged = scans.scan_file_exact(df, head=head, days=(day, day))
    full = scans.scan_file_exact(df, head=head).where(F.col("business_date") == F.lit(day))
    assert sorted(map(tuple, ranged.collect())) == sorted(map(tuple, full.collect())) and full.count() == 6
