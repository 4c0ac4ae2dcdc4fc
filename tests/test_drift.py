import datetime as dt

from tidemark.operators.drift import clade_table, field_names, schema_changes

SCHEMA = "build_id long, pathogen string, build_date string, kind string, payload_format string, payload string, loaded_at timestamp, field string, clade string"
T = dt.datetime(2025, 1, 1)


def run(spark, files):
    rows = [(i, "p", d, "k", f, x, T + dt.timedelta(days=late), "clash", "clash") for i, (d, f, x, late) in enumerate(files)]
    return spark.createDataFrame(rows, SCHEMA)


def changes(spark, files):
    return {(r.build_id, r.field_name, r.change_kind) for r in schema_changes(run(spark, files)).collect()}


def test_tsv_changes(spark):
    a = "clade\tn\tverdict\told\nc1\t1\tpass\tx\nc2\t2\tfail\ty\n"
    b = '﻿# note\r\n"verdict"\t"clade "\t"n"\t"new"\r\n"true"\t"c1"\t"1"\t"x"\r\n"false"\t"c2"\t"2,5"\t"y"\r\n'
    c = "clade\tn\tverdict\tnew\textra\rc1\t3\ttrue\tx\t\rc2\t4\tfalse\tz\t\r"
    assert changes(spark, [("1", "tsv", a, 0), ("2", "tsv", b, 0), ("3", "tsv", c, 0)]) == {(1, "new", "renamed"), (1, "verdict", "retyped"), (1, "n", "retyped"), (2, "n", "retyped"), (2, "extra", "added")}


def test_json_changes_and_latest_file(spark):
    a = '[{"clade": "c1", "n": 1, "l": [1, 2], "gone": null}, {"clade": "c2", "n": 2.5, "l": []}]'
    b = '{"clade": "c1", "n": "1", "l": "1;2"}\n# comment\n{"clade": "c2", "n": "2", "l": "3"}\n'
    wrong = '[{"clade": "c1", "other": 1}]'
    assert changes(spark, [("1", "json", a, 0), ("2", "json", wrong, 0), ("2", "json", b, 5)]) == {(2, "n", "retyped"), (2, "l", "retyped"), (2, "gone", "removed")}


def test_broken_empty_and_null_payloads(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [("1", "tsv", None, 0), ("2", "json", "no json", 0), ("3", "tsv", "", 0), ("4", "tsv", "clade\tn\nc1\n", 0), ("5", "tsv", "clade\tn\nc1\t2\textra\n", 0)]) == set()


def test_table_follows_names_and_reports_failed_casts(spark):
    a, b = "clade\tn_tips\tslope\nc1\t5\t1e-3\nc2\t6\t2e-3\n", "clade\ttips\tslope\nc1\t5\tn/a\nc2\t6\t2e-3\n"
    rows = {(r.build_date, r.clade): r for r in clade_table(run(spark, [("1", "tsv", a, 0), ("2", "tsv", b, 0)])).collect()}
    assert rows["2", "c1"].n_tips == 5 and rows["2", "c1"].failed == {"slope": "n/a"} and rows["2", "c2"].slope == 0.002


def test_table_keeps_every_field(spark):
    a = "clade\tn_tips\trate_hpd\tnotes\nc1\t5\t0.1-0.2\tseen\nc2\t6\t0.3-0.4\t\n"
    b = "clade\tn_tips\ttips\trateHpd\tis_clocklike\nc1\t5\t7\t0.1-0.2\ttrue\nc2\t6\t8\t0.3-0.4\tfalse\n"
    c = '[{"clade": "c1", "n_tips": 5, "n_countries": 3, "is_clocklike": true}]'
    rows = {(r.build_date, r.clade): {k: (v.value, v.raw_type) for k, v in r.rest.items()} for r in clade_table(run(spark, [("1", "tsv", a, 0), ("2", "tsv", b, 0), ("3", "json", c, 0)])).collect()}
    assert rows["1", "c1"] == {"rate_hpd": ("0.1-0.2", "cell"), "notes": ("seen", "cell")} and rows["1", "c2"] == {"rate_hpd": ("0.3-0.4", "cell")}
    assert rows["2", "c1"] == {"tips": ("7", "cell"), "rate_hpd": ("0.1-0.2", "cell"), "is_clocklike": ("true", "cell")}
    assert rows["3", "c1"] == {"n_countries": ("3", "number"), "is_clocklike": ("true", "flag")}


def test_names_through_seven_renames(spark):
    chain = ["slope", *(f"s{i}" for i in range(7))]
    renames = [(new, "renamed", old) for old, new in zip(chain, chain[1:], strict=False)] + [("rateHpd", "renamed", "rate_hpd"), ("hpd", "renamed", "rateHpd")]
    got = {r.field: r.column for r in field_names(spark.createDataFrame(renames, "field_name string, change_kind string, old_name string")).collect()}
    assert all(got[n] == "slope" for n in chain) and got["rateHpd"] == got["rate_hpd"] == got["hpd"] == "hpd"
