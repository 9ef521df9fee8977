import datetime as dt
import re
from pathlib import Path
from zoneinfo import ZoneInfo

import pytest

from newsweft.operators.timestamps import ZONE_MINUTES, found, normalise_timestamps

DATA = "/root/testdata/sf0.001"
OUTLETS = [("A", "America/Toronto", False), ("B", "America/St_Johns", True), ("A", "America/Toronto", False)]


def run(spark, rows, **options):
    a = spark.createDataFrame(rows, "_id string, outlet string, publishedAt string, status string")
    o = spark.createDataFrame(OUTLETS, "outlet string, tz string, day_first boolean")
    return {r["_id"]: (r["published_us"], r["status"]) for r in normalise_timestamps(a, o, **options).collect()}


def us(*args, zone="UTC", micro=0):
    return int(dt.datetime(*args, tzinfo=ZoneInfo(zone)).timestamp()) * 1_000_000 + micro


CASES = [
    ("A", "2021-03-04T05:06:07Z", us(2021, 3, 4, 5, 6, 7)),
    ("A", "20210304T050607Z", us(2021, 3, 4, 5, 6, 7)),
    ("A", "2021-03-04T05:06:07.123456-02:30", us(2021, 3, 4, 7, 36, 7, micro=123456)),
    ("A", "2021-07-04 05:06", us(2021, 7, 4, 5, 6, zone="America/Toronto")),
    ("A", "03/04/2021 14:00", us(2021, 3, 4, 14, zone="America/Toronto")),
    ("B", "03/04/2021 14:00", us(2021, 4, 3, 14, zone="America/St_Johns")),
    ("B", "5/9/2020 1:44 p.m.", us(2020, 9, 5, 13, 44, zone="America/St_Johns")),
    ("A", "Thu, 11 Oct 2018 02:51:50 -0400", us(2018, 10, 11, 6, 51, 50)),
    ("A", "Nov 7, 2018 1:15 AM NST", us(2018, 11, 7, 4, 45)),
    ("A", "1er mars 2019 à 5h15 HNA", us(2019, 3, 1, 9, 15)),
    ("A", "30 décembre 2018, 13 h 45", us(2018, 12, 30, 13, 45, zone="America/Toronto")),
    ("A", "1540993623", us(2018, 10, 31, 13, 47, 3)),
    ("A", "1540993623537", us(2018, 10, 31, 13, 47, 3, micro=537000)),
    ("A", '{"$date": "2018-10-06T07:08:34.940Z"}', us(2018, 10, 6, 7, 8, 34, micro=940000)),
    ("A", '{"$date": 1545625605573}', us(2018, 12, 24, 4, 26, 45, micro=573000)),
    ("A", "2018-10-16T04:41:32-06:00[America/Regina]", us(2018, 10, 16, 10, 41, 32)),
    (None, "2018-10-16T04:41:32Z", us(2018, 10, 16, 4, 41, 32)),
]
STATUS = [
    ("A", "2021-03-14 02:30:00", "clock_never"), ("A", "2021-11-07 01:30:00", "clock_twice"), ("A", "2020-02-30T10:00:00Z", "impossible"),
    ("A", "2019-13-05 08:00", "impossible"), ("A", "2019-01-27", "date_only"), ("A", "yesterday", "unreadable"), ("A", "", "unreadable"), ("A", None, "missing"),
    (None, "2021-07-04 05:06", "no_zone"), ("C", "July 7, 2019, 11:42 AM", "no_zone"),
]


def test_instants(spark):
    got = run(spark, [(str(k), o, t, "x") for k, (o, t, _) in enumerate(CASES)])
    assert [(t, got[str(k)][0]) for k, (_, t, _) in enumerate(CASES)] == [(t, want) for _, t, want in CASES]


def test_statuses(spark):
    got = run(spark, [(str(k), o, t, "x") for k, (o, t, _) in enumerate(STATUS)])
    assert [(STATUS[k][1], got[str(k)]) for k in range(len(STATUS))] == [(t, (None, s)) for _, t, s in STATUS]


def test_mixture_decides(spark):
    """A source whose texts contradict its stated day order is read as its texts show; the prior alone reads it wrongly."""
    rows = [(f"u{d}", "A", f"{d}/04/2021 10:00", "x") for d in range(13, 29)] + [("amb", "A", "03/04/2021 10:00", "x"), ("few", "B", "03/25/2021 10:00", "x"), ("amb2", "B", "03/04/2021 10:00", "x")]
    want = us(2021, 4, 3, 10, zone="America/Toronto")
    got = run(spark, rows)
    assert got["amb"] == (want, "exact") and got["amb2"] == (None, "ambiguous")
    alone = run(spark, rows, rounds=0)
    assert alone["amb"][0] != want


def test_repeated_and_empty(spark):
    row = ("1", "A", "2021-03-04T05:06:07Z", "x")
    assert len(run(spark, [row, row])) == 1
    assert run(spark, [row])["1"][1] == "exact"
    a = spark.createDataFrame([], "_id string, outlet string, publishedAt string")
    assert found(a, spark.createDataFrame(OUTLETS, "outlet string, tz string, day_first boolean")).count() == 0


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
def test_zoned_texts_against_python(spark):
    """Brute force over the table's ISO texts with a zone."""
    a = spark.read.parquet(f"{DATA}/articles.parquet")
    got = {r["_id"]: r["published_us"] for r in found(a, spark.read.parquet(f"{DATA}/outlets.parquet")).collect()}
    checked = 0
    for r in a.select("_id", "publishedAt").collect():
        if r[1] and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)", r[1]):
            try:
                t = dt.datetime.fromisoformat(r[1])
            except ValueError:
                assert r[0] not in got
                continue
            assert got[r[0]] == (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
            checked += 1
    assert checked
    assert ZONE_MINUTES["HAT"] == ZONE_MINUTES["NDT"]
