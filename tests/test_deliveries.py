"""Delivery files are found by their names, and those of other days are not opened."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.deliveries import read_deliveries, write_delivery
from ledgerloom.sources.scans import scan_file_exact, scan_file_prefix

SCHEMA = "id INT, ch STRING"
DAY = dt.date(2021, 1, 5)


def rows_of(df):
    return sorted((r["id"], str(r["business_date"])) for r in df.select("id", "business_date").collect())


@pytest.fixture
def folder(tmp_path):
    def put(name, text):
        (tmp_path / name).write_text("id,ch\n" + text)

    put("20210106_settlement.csv", "1,SB\n2,FE\n")
    put("20210107_settlement.csv", "3,SB\n")
    put("STL-20210105.01.009.CSV", "4,SB\n5,FE\n")
    put("stl-20210105.01.009.csv", "6,sb\n")
    put("STL-20210106.01.009.CSV", "7,SB\n")
    put("notes.csv", "")
    return tmp_path


def test_names_of_files_are_days(spark, folder):
    rows = read_deliveries(spark, str(folder), SCHEMA)
    dated = scan_file_prefix(rows).where(F.col("business_date").isNotNull())
    assert rows_of(dated) == [(1, "2021-01-05"), (2, "2021-01-05"), (3, "2021-01-06")]
    assert rows_of(scan_file_exact(rows)) == [(4, "2021-01-05"), (6, "2021-01-05"), (7, "2021-01-06")]


def test_files_of_other_days_are_not_opened(spark, folder):
    for name in ("20210107_settlement.csv", "STL-20210106.01.009.CSV", "notes.csv"):
        (folder / name).write_text("id,ch\nno number,SB\n")
    rows = read_deliveries(spark, str(folder), SCHEMA)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        rows_of(scan_file_prefix(rows))
    assert rows_of(scan_file_prefix(rows, days=(DAY, DAY))) == [(1, "2021-01-05"), (2, "2021-01-05")]
    assert rows_of(scan_file_exact(rows, days=(DAY, DAY))) == [(4, "2021-01-05"), (6, "2021-01-05")]


def test_deliveries_add_up(spark, tmp_path):
    path = str(tmp_path / "in")
    for name, ids in (("20210106_a", [1, 2]), ("20210107_a", [3]), ("20210106_b", [4])):
        write_delivery(spark.createDataFrame([(i, "SB") for i in ids], SCHEMA).coalesce(1), path, name)
    rows = read_deliveries(spark, path, SCHEMA)
    assert rows_of(scan_file_prefix(rows)) == [(1, "2021-01-05"), (2, "2021-01-05"), (3, "2021-01-06"), (4, "2021-01-05")]
    assert rows_of(scan_file_prefix(rows, days=(DAY, DAY))) == [(1, "2021-01-05"), (2, "2021-01-05"), (4, "2021-01-05")]
