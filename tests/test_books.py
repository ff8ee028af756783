"""Published states: all or nothing, only what changed, only what is asked for; closes that break off; replays."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import controls as C
from ledgerloom.plans import books as B
from ledgerloom.plans import daily_close as DC
from ledgerloom.sources.snapshots import Snapshots, merge_partitions, partition_folder, replace_batches
from ledgerloom.streaming.post import post_batch

SCHEMA = "day STRING, id INT, amount INT"
DAYS = ["2021-01-05", "2021-01-06", "2021-02-07"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def put(books, df, base=None):
    return books.publish(base or books.latest(), [books.write(df, "t", SCHEMA, ["day"])])


def files_of(books, day):
    known = books.latest().tables["t"].partitions[f"day={day}"]
    return {p: p.stat().st_mtime_ns for p in Path(books.root, "data", "t", f"commit={known}", f"day={day}").glob("*.parquet")}


@pytest.fixture
def books(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "books"))


def test_a_write_is_seen_only_when_published(spark, books):
    assert rows_of(books.read("t", SCHEMA)) == [] and books.latest().number == 0
    first = put(books, frame(spark, ("a", 1, 1), ("b", 2, 2)))
    before = books.read("t", SCHEMA)
    written = books.write(frame(spark, ("a", 1, 9)), "t", SCHEMA, ["day"])
    assert rows_of(books.read("t", SCHEMA)) == [("a", 1, 1), ("b", 2, 2)]
    assert books.unfinished() == [f"t/commit={written.commit}"]
    books.publish(first, [written])
    assert rows_of(books.read("t", SCHEMA)) == [("a", 1, 9), ("b", 2, 2)]
    assert rows_of(before) == [("a", 1, 1), ("b", 2, 2)] == rows_of(books.read("t", SCHEMA, first))


def test_of_two_runs_from_one_state_the_second_fails(spark, books):
    base = put(books, frame(spark, ("a", 1, 1)))
    put(books, frame(spark, ("a", 1, 2)), base)
    with pytest.raises(Exception):
        put(books, frame(spark, ("a", 1, 3)), base)
    assert rows_of(books.read("t", SCHEMA)) == [("a", 1, 2)]
    with pytest.raises(ValueError):
        books.publish(books.latest(), [books.write(frame(spark, ("a", 1, 1)), "t", SCHEMA, ["id"])])


def test_cleaning_keeps_what_the_last_states_need(spark, books):
    for amount in range(4):
        put(books, frame(spark, ("a", 1, amount), *([("b", 2, 0)] if amount == 0 else [])))
    books.write(frame(spark, ("c", 3, 3)), "t", SCHEMA, ["day"])
    assert len(books.clean(keep=2)) == 2 and books.unfinished() == [] and books.clean(keep=2) == []
    assert rows_of(books.read("t", SCHEMA)) == [("a", 1, 3), ("b", 2, 0)]


@pytest.mark.parametrize("value", ["plain", "a=b/c", "50%", "x:y z", "", None])
def test_folder_names_are_those_spark_writes(spark, books, value):
    put(books, frame(spark, (value, 1, 1)))
    assert set(books.latest().tables["t"].partitions) == {partition_folder({"day": value})}
    assert rows_of(books.read("t", SCHEMA)) == [(value or None, 1, 1)]


def test_a_merge_writes_only_touched_partitions(spark, books):
    base = put(books, frame(spark, ("a", 1, 1), ("a", 2, 2), ("b", 3, 3), (None, 4, 4)))
    before = files_of(books, "b")
    part, _ = merge_partitions(books, base, "t", SCHEMA, ["day"], frame(spark, ("a", 2, 20), ("c", 5, 5)), ["id"])
    assert set(part.partitions) == {"day=a", "day=c"}
    books.publish(base, [part])
    assert rows_of(books.read("t", SCHEMA)) == sorted([("a", 1, 1), ("a", 2, 20), ("b", 3, 3), ("c", 5, 5), (None, 4, 4)], key=str)
    assert files_of(books, "b") == before


def test_replacing_empties_batches_without_rows(spark, books):
    base = put(books, frame(spark, ("a", 1, 1), ("a", 2, 2), ("b", 3, 3)))
    closed = spark.createDataFrame([("a", 2), ("b", 3)], "day string, id int")
    part, gone = replace_batches(books, base, frame(spark, ("a", 2, 7), ("a", 9, 9)), "t", SCHEMA, closed, ["id"], ["day"])
    books.publish(base, [part], {"t": gone})
    assert rows_of(books.read("t", SCHEMA)) == [("a", 1, 1), ("a", 2, 7)]  # b is gone, and a row of no closed batch is not posted


# --- closes ------------------------------------------------------------------


def _lines(spark, bad=()):
    rows = ", ".join(
        f"(DATE'{d}', 'LMX1', 'ACL_{d[5:7]}{d[8:]}{d[:4]}', '{'' if d in bad else '061-40000-000'}', {n}, 0), (DATE'{d}', 'LMX1', 'ACL_{d[5:7]}{d[8:]}{d[:4]}', '061-10005-000', 0, {n})"
        for n, d in enumerate(DAYS, 1))
    lines = spark.sql(f"SELECT * FROM VALUES {rows} AS t(business_date, company, batchid, account, debit, credit)")
    wanted = [x.strip().split()[0] for x in DC.STAGED.replace("DECIMAL(15,2)", "DECIMAL").split(",")]
    lines = lines.withColumns({"journal": F.lit("a_sales"), "merchant": F.lit("m"), "distref": F.concat(F.lit("r"), "account"), "checkbookid": F.lit("Operating")})
    return lines.withColumns({c: F.lit(None).cast("string") for c in wanted if c not in lines.columns})


@pytest.fixture
def flow(spark, books, monkeypatch):
    """Books with day frames of three days, and journals that are these days' lines."""
    days = spark.sql(f"SELECT CAST(d AS DATE) AS business_date, 'LMX1' AS company, 1 AS x FROM VALUES {', '.join(f'({d!r})' for d in DAYS)} AS t(d)")
    B.store_frames(books, B.DayFrames(*[days] * 5))
    now = F.lit("2021-03-01 00:00:00").cast("timestamp")
    bad = set()

    def lines(frames, matrix, stamps):
        known = frames.ledger.select("business_date", "company").distinct()
        own = _lines(spark, bad).join(known, ["business_date", "company"], "left_semi")
        lost = frames.ledger.filter("company IS NULL").select("business_date").distinct()
        extra = _lines(spark).withColumn("company", F.lit(None).cast("string")).join(lost, "business_date", "left_semi")
        return own.unionByName(extra.select(*own.columns))

    def results(frames):
        named = {c.split()[0]: c.split()[1] for c in B.RESULT.replace(", ", "|").split("|")}
        df = frames.ledger.withColumns({n: F.lit(None).cast(t) for n, t in named.items() if n not in ("business_date", "company")})
        df = df.withColumns({"status": F.lit("matched"), "business_month": F.date_format("business_date", "yyyy-MM")}).drop("x")
        return df, df.drop("status").withColumns({"exception_num": F.lit(1).cast("bigint"), "exception_id": F.lit("e")}).limit(0)

    monkeypatch.setattr(B, "journal_lines", lines)
    monkeypatch.setattr(B, "results", results)

    def close(**how):
        return B.close(books, days, days, None, B.Stamps(now, now, "", ""), **how)

    close.bad, close.days = bad, days
    return close


def posted(books):
    return {
        "common": rows_of(books.read("common", DC.COMMON)), "history": rows_of(books.read("history", B.HISTORY)),
        "matches": rows_of(books.read("matches", B.MATCHES)), "exception_history": rows_of(books.read("exception_history", B.EXCEPTION_HISTORY)),
    }


def test_a_close_posts_once_and_is_then_done(books, flow):
    assert {(str(r.business_date), r.decision) for r in flow().status.collect()} == {(d, "publish") for d in DAYS}
    after, number = posted(books), books.latest().number
    assert len(after["common"]) == 6 and [(r[0], str(r[3])) for r in after["history"]] == list(zip((1, 2, 3), DAYS)) and len(after["matches"]) == 3
    assert flow().status.count() == 0 and books.latest().number == number and posted(books) == after


@pytest.mark.parametrize("failing", [1, 2, 3, 4, "publish"])
def test_a_close_that_breaks_off_anywhere_leaves_its_days_pending(books, flow, monkeypatch, failing):
    flow.bad.add(DAYS[1])
    flow()  # one day is stopped by a gate
    flow.bad.clear()
    before, number = posted(books), books.latest().number
    assert [str(r[3]) for r in before["history"]] == [DAYS[0], DAYS[2]]
    seen = []
    write, publish = Snapshots.write, Snapshots.publish

    def breaking_write(self, *args):
        seen.append(args[1])
        out = write(self, *args)
        if len(seen) == failing:
            raise RuntimeError("lost")
        return out

    def breaking_publish(self, *args):
        if failing == "publish":
            raise RuntimeError("lost")
        return publish(self, *args)

    with monkeypatch.context() as broken:
        broken.setattr(Snapshots, "write", breaking_write)
        broken.setattr(Snapshots, "publish", breaking_publish)
        with pytest.raises(RuntimeError):
            flow()
    assert posted(books) == before and books.latest().number == number and books.unfinished()
    flow()
    after = posted(books)
    assert books.unfinished() == [] and len(after["common"]) == 6
    assert [(r[0], str(r[3])) for r in after["history"]] == [(1, DAYS[0]), (2, DAYS[2]), (3, DAYS[1])]


def test_an_exception_run_skips_gates_and_writes_both_histories(books, flow):
    flow.bad.update(DAYS)
    assert {r.decision for r in flow().status.collect()} == {"stop"} and posted(books)["history"] == []
    flow(exception_run=True)
    after = posted(books)
    assert [r[:1] for r in after["history"]] == [(1,), (2,), (3,)] and {r[5] for r in after["exception_history"]} == {"EXCEPTION"} and len(after["common"]) == 6


def test_rows_without_company_stop_nothing_but_are_reported(spark, books, flow):
    lost = flow.days.limit(1).withColumn("company", F.lit(None).cast("string"))
    B.store_frames(books, B.DayFrames(flow.days.unionByName(lost), *[flow.days] * 4))
    status = {(r.company, r.decision, r.failed_gate) for r in flow().status.collect()}
    assert status == {("LMX1", "publish", None), (None, "stop", "identity")} and len(posted(books)["common"]) == 6


def test_a_close_opens_only_the_folders_of_its_days(spark, books, flow):
    table = books.latest().tables["ledger"]
    for name in B.DayFrames.__dataclass_fields__:
        known = books.latest().tables[name].partitions
        for p in [x for x in known if DAYS[0] not in x]:  # opening any of these would fail
            for file in Path(books.root, "data", name, f"commit={known[p]}", p).glob("*.parquet"):
                file.write_bytes(b"no parquet")
                Path(file.parent, f".{file.name}.crc").unlink(missing_ok=True)
    now = F.lit("2021-03-01 00:00:00").cast("timestamp")
    B.close(books, flow.days.filter(F.col("business_date") == DAYS[0]), flow.days, None, B.Stamps(now, now, "", ""))
    assert len(table.partitions) == 3 and len(posted(books)["common"]) == 2
    todo = B.stage(B.agenda(books.read("history", B.HISTORY), flow.days), "agenda").filter("state = 'pending'")
    plan = B.load_frames(books, books.latest()).of_days(todo).ledger._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_the_identity_gate_comes_first(spark):
    lines = _lines(spark).withColumn("company", F.lit(None).cast("string"))
    status = C.gate_status(C.identity(lines).withColumns({"gate": F.lit("identity"), "journal": F.lit("all")})).collect()
    assert {r.failed_gate for r in status} == {"identity"} and all("no company" in r.alert for r in status)


def test_a_replayed_micro_batch_changes_nothing(spark, books):
    def merge(old, new):
        return old.unionByName(new).groupBy("day", "id").agg(F.sum("amount").cast("int").alias("amount")).select("day", "id", "amount")

    post = post_batch(books, "s", "t", SCHEMA, ["day"], lambda df: df, merge)
    post(frame(spark, ("a", 1, 1), ("b", 2, 2)), 0)
    kept = files_of(books, "b")
    post(frame(spark, ("a", 1, 5)), 1)
    number = books.latest().number
    post(frame(spark, ("a", 1, 5)), 1)
    post(frame(spark, ("a", 1, 1)), 0)
    assert rows_of(books.read("t", SCHEMA)) == [("a", 1, 6), ("b", 2, 2)] and books.latest().number == number and files_of(books, "b") == kept
    other = post_batch(books, "other", "t", SCHEMA, ["day"], lambda df: df, merge)
    other(frame(spark, ("a", 1, 1)), 0)
    assert rows_of(books.read("t", SCHEMA))[0] == ("a", 1, 7)
