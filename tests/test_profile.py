import datetime as dt

from tidemark.operators.profile import column_profile, distribution_changes, quality_cases

SCHEMA = "row_id long, load_id int, collection_date string, lat_lon string, segment string, value string, n double"


def test_cells_to_the_letter(spark):
    good = [("2020-02-29", "12.34 N 56.78 E", "10"), ("1900", "90 S 180 W", "1"), ("2001-12/2002", "0.5 N 0.5 E", "9"), (None, "", None)]
    bad = [("2019-02-29", "-12.3 N 56.7 E", "01"), ("1899", "90.5 N 10 E", "11"), ("2026", "12.3  N 56.7 E", " 1"), (" ", "12.3 E 56.7 N", "x"), ("2001/2002/2003", "12.3N56.7E", "1.0"), ("2020-1-1", "10 N 181 E", "²")]
    rows = [(i, 0, *r, "v", 1.0) for i, r in enumerate(good + bad)]
    got = {(r.field_name, r.case_id) for r in quality_cases(spark.createDataFrame(rows, SCHEMA)).where("case_kind = 'cell'").collect()}
    assert got == {(f, len(good) + i) for f in ("collection_date", "lat_lon", "segment") for i in range(len(bad))}


def test_changed_loads(spark):
    rows = [(i, 0, "2020", None, "1", "v", 1.0) for i in range(10)] + [(10 + i, 2, "2020-01" if i < 4 else "2020", None, "1" if i < 7 else None, "v", 1.0) for i in range(10)] + [(20 + i, 3, "2020-01" if i < 4 else "2020", "1 N 1 E", "1" if i < 7 else "2", "v", 1.0) for i in range(10)]
    got = {(r.field_name, r.case_id) for r in quality_cases(spark.createDataFrame(rows, SCHEMA)).where("case_kind = 'load'").collect()}
    assert got == {("collection_date", 2), ("segment", 2), ("lat_lon", 3), ("segment", 3)}


def test_profile_counts_and_empty(spark):
    rows = [(1, 0, None, "", "1", "a", 2.0), (2, 0, "x", "b", "1", "a", None), (2, 0, "x", "b", "1", "a", None), (3, None, "x", "b", "1", "y" * 200_000, -1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.load_id, r.field_name): r for r in column_profile(df).collect()}
    assert (got[0, "n"].n_missing, got[0, "n"].n_distinct, got[0, "n"].min_number) == (2, 1, 2.0)
    assert (got[0, "lat_lon"].n_missing, got[0, "lat_lon"].n_broken, got[0, "lat_lon"].n_distinct) == (1, 2, 1)
    assert got[None, "value"].n_rows == 1
    empty = df.where("false")
    assert column_profile(empty).count() == quality_cases(empty).count() == distribution_changes(empty).count() == 0


def test_drift_of_categories_years_magnitudes_and_tails(spark):
    schema = "load_id int, host string, flag boolean, day string, number double, seen timestamp, text string, same string"

    def row(load, i):
        new = load == 2
        text = f"invented virus isolate A/{load * 1000 + i} {'fusion protein gene, partial' if new else 'matrix protein gene, complete'} cds"
        return load, "seal" if new else "rodent", new, f"{2010 + 9 * new + i % 3}-0{1 + i % 9}-{10 + i % 18}", 1100.0 + i / 4 + 130 * new, dt.datetime(2020 + new, 1, 1) + dt.timedelta(minutes=i), text, f"{'abc'[i % 3]}"

    df = spark.createDataFrame([row(load, i) for load in (0, 1, 2) for i in range(400)], schema)
    got = {(r.load_id, r.field_name): r for r in distribution_changes(df).collect()}
    assert {f for load, f in got if load == 2 and got[load, f].shifted} == {"host", "flag", "day", "number", "seen", "text"}
    assert not any(r.shifted for (load, _), r in got.items() if load == 1)


def test_nested_columns(spark):
    df = spark.createDataFrame([(1, [1, 2], (1, None)), (1, [1, 2], (1, "x")), (1, None, None)], "load_id int, l array<int>, s struct<a:int,b:string>")
    got = {r.field_name: (r.n_rows, r.n_missing, r.n_distinct, r.min_text) for r in column_profile(df).collect()}
    assert got == {"l": (3, 1, 1, "[1,2]"), "s": (3, 1, 2, '{"a":1,"b":"x"}')}
