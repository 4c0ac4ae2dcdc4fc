import datetime as dt
import zoneinfo

import pytest

from tidemark.operators.timestamps import normalise_timestamps

US = 1_000_000


def day(y, m=1, d=1):
    return int(dt.datetime(y, m, d, tzinfo=dt.UTC).timestamp()) * US


@pytest.fixture(scope="module")
def read(spark):
    sites = spark.createDataFrame(
        [(1, "s", "America/New_York", False, "EST", "EDT"), (2, "s", "Europe/Berlin", True, "CET", "CEST"), (3, "s", None, None, None, None), (3, "twice", None, None, None, None)],
        "site_id int, site_name string, tz_name string, day_first boolean, std_abbr string, dst_abbr string",
    )

    def run(texts, site=2):
        rows = [(i, "a", t, 1950, 2026, site, "clash", 7) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "date_id long, accession string, raw string, min_year int, max_year int, site_id int, zone string, year int")
        return [(r.outcome, r.precision, r.start_us, r.end_us) for r in normalise_timestamps(df, sites).orderBy("date_id").collect()]

    return run


def test_spans(read):
    want = {
        "2013-08-14": ("day", day(2013, 8, 14), day(2013, 8, 15)), "14-Aug-2013": ("day", day(2013, 8, 14), day(2013, 8, 15)), "14-AUG-13": ("day", day(2013, 8, 14), day(2013, 8, 15)),
        "14. März 2013": ("day", day(2013, 3, 14), day(2013, 3, 15)), "7 de mayo de 1985": ("day", day(1985, 5, 7), day(1985, 5, 8)), "1 août 2001": ("day", day(2001, 8, 1), day(2001, 8, 2)),
        "May 13, 1981": ("day", day(1981, 5, 13), day(1981, 5, 14)), "20250101": ("day", day(2025), day(2025, 1, 2)), "2016-02": ("month", day(2016, 2), day(2016, 3)), "Dec–2018": ("month", day(2018, 12), day(2019)),
        " 2013 ": ("year", day(2013), day(2014)), "2011/2013": ("range", day(2011), day(2014)), "2025 / 2024": ("range", day(2024), day(2026)), "2010-03-06/2010-12-07": ("range", day(2010, 3, 6), day(2010, 12, 8)),
        "3/4/2020": ("day", day(2020, 4, 3), day(2020, 4, 4)), "10-JUL-93": ("day", day(1993, 7, 10), day(1993, 7, 11)), "01-JAN-27": None,
    }
    for text, got in zip(want, read(list(want)), strict=True):
        assert got == (("ok", *want[text]) if want[text] else ("unreadable", None, None, None)), text


def test_no_meaning(read):
    texts = [None, "", "  ", "unknown", "2013-13-45", "2013-02-30", "2013-02-29", "0000-01-01", "3013", "1013", "2019-1-2-3", "??-2013", "week 14", "2017-04-09T25:10:00+01:00", "2016-09-09 14:75", "13/13/2020", "2013-14-01/2013-15-01", "x" * 100_000]
    assert all(r == ("unreadable", None, None, None) for r in read(texts))


def test_slashed_dates(read):
    assert read(["24/02/2019", "02/24/2019"], 1)[0][0] == "unreadable"
    assert read(["02/24/2019"], 1)[0][2] == day(2019, 2, 24)
    assert [r[0] for r in read(["24/02/2019", "02/24/2019", "05/05/2019", "02/03/2019"], 3)] == ["ok", "ok", "ok", "unreadable"]


def test_clock_times(read):
    at = lambda s, z: int(dt.datetime.fromisoformat(s).replace(tzinfo=zoneinfo.ZoneInfo(z)).timestamp()) * US
    want = {
        "2020-07-01T12:00:00": at("2020-07-01T12:00", "Europe/Berlin"), "2020-01-01 00:05 CET": at("2020-01-01T00:05", "Europe/Berlin"), "2020-07-01 12:00:00.5Z": at("2020-07-01T12:00", "UTC") + US // 2,
        "2020-07-01 12:00+0530": at("2020-07-01T12:00", "Asia/Kolkata"), "2020-07-01T12:00[America/New_York]": at("2020-07-01T12:00", "America/New_York"), "1600000000": 1600000000 * US, "1600000000123": 1600000000123 * 1000,
        "Wed, 08 Oct 2025 21:06:00 +0000": at("2025-10-08T21:06", "UTC"), "20150601T060700": at("2015-06-01T06:07", "Europe/Berlin"), "20150601T060700Z": at("2015-06-01T06:07", "UTC"), "01/06/2020 12:13 AM": at("2020-06-01T00:13", "Europe/Berlin"), "19.11.2020, 02:09:45": at("2020-11-19T02:09:45", "Europe/Berlin"),
        "2022-10-30 02:30 CEST": at("2022-10-30T00:30", "UTC"), "2022-10-30 02:30 CET": at("2022-10-30T01:30", "UTC"),
    }
    for text, got in zip(want, read(list(want)), strict=True):
        assert got == ("ok", "time", want[text], want[text]), text


def test_zone_outcomes(read):
    assert [r[0] for r in read(["2022-10-30 02:30", "2022-03-27 02:30", "2020-01-01 10:00 EST", "2020-01-01 10:00 Mars/Base"])] == ["ambiguous", "nonexistent", "no_zone", "no_zone"]
    assert [r[0] for r in read(["2020-01-01 10:00", "2020-01-01 10:00 UTC"], 3)] == ["no_zone", "ok"]
    assert [r[0] for r in read(["2020-01-01 10:00"], None)] == ["no_zone"]


def test_every_hour_of_two_years_against_zoneinfo(read):
    zone, start = zoneinfo.ZoneInfo("America/New_York"), dt.datetime(2018, 12, 30)
    times = [start + dt.timedelta(minutes=30 * k) for k in range(2 * 366 * 48)]
    got = read([t.strftime("%Y-%m-%dT%H:%M:%S") for t in times], 1)
    for t, (outcome, _, at, _) in zip(times, got, strict=True):
        options = {int(t.replace(tzinfo=zone, fold=f).timestamp()) for f in (0, 1)}
        real = {u for u in options if dt.datetime.fromtimestamp(u, zone).replace(tzinfo=None) == t}
        want = ("ok", real.pop() * US) if len(real) == 1 else ("ambiguous" if real else "nonexistent", None)
        assert (outcome, at) == want, t


def test_empty_table(read):
    assert read([]) == []
