import pytest
from pyspark.sql import functions as F

from paylens.functions.calendar import (
    days_crossed, event_time, is_calendar_date, is_calendar_date_time, iso_text, month_text,
    partition_time, whole_days_between, year_text)

DATES = {
    "2026-01-01": True, "2026-02-28": True, "2028-02-29": True, "2026-02-29": False,
    "2026-02-30": False, "2026-13-01": False, "2026-00-10": False, "2026-01-00": False,
    "2026-1-01": False, "0999-01-01": False, "": False, "2026-01-01 00:00:00": False,
}
DATE_TIMES = {
    "2026-07-21 00:00:00": True, "2026-07-21 23:59:59": True, "2028-02-29 12:30:45": True,
    "2026-02-30 12:30:45": False, "2026-07-21 24:00:00": False, "2026-07-21 12:60:00": False,
    "2026-07-21 12:30:60": False, "2026-07-21T12:30:00": False, "2026-07-21": False,
}


@pytest.mark.parametrize("check, table", [
    (is_calendar_date, DATES), (is_calendar_date_time, DATE_TIMES)])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_formats(spark, check, table, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(list(table.items()), "v string, expected boolean")
        assert df.withColumn("got", check("v")).filter("got <> expected").collect() == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_time_takes_only_date_times(spark):
    rows = spark.createDataFrame(
        [("2026-01-01 00:00:00",), ("2026-1-1 1:2:3",), ("2026-01-01",), ("2026-02-30 00:00:00",),
         (None,)], "v string")
    got = [r[0] for r in rows.select(event_time(F.col("v")).cast("string")).collect()]
    assert got == ["2026-01-01 00:00:00", "2026-01-01 01:02:03", None, None, None]


def test_partition_time_formats(spark):
    rows = spark.createDataFrame([
        ("2026-07-21",), ("2026-07-21T10:00:00Z",), (" 2026-07-21 10:00:00.123456 ",),
        ("2026-07-01T00:30:00+05:00",), ("20260721",), ("2026-7-2 1:2:3",), ("21/07/2026",),
    ], "v string").withColumn("p", iso_text(F.col("v")))
    timed = rows.withColumn("t", partition_time(F.col("p")))
    got = [tuple(r) for r in timed.select(year_text(F.col("t")), month_text(F.col("t"))).collect()]
    assert got == [("2026", "07")] * 6 + [(None, None)]


def test_days(spark):
    row = spark.sql("""select timestamp_ntz'2026-01-01 23:59:59' as a,
        timestamp_ntz'2026-01-02 00:00:01' as b, timestamp_ntz'2027-01-02 23:59:58' as c""")
    got = row.select(days_crossed(F.col("a"), F.col("b")), whole_days_between(F.col("a"), F.col("b")),
                     whole_days_between(F.col("a"), F.col("c"))).first()
    assert tuple(got) == (1, 0, 365)
