import random
from collections import Counter

import pytest

from tidemark.llm.sampling import category_members, draw_samples, sample_report, unmet_targets

TARGETS = [(1, "host_group", "dog", 0.5, None, 40), (1, "host_group", "seal", 0.3, 15, 40), (1, "host_group", "newt", 0.2, None, 40), (2, "decade", "2010s", 1.0, None, 5)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    rows = [(i, i % 3, f"A{i % 260}", "dog" if i % 260 < 200 else "seal" if i % 260 < 210 else rng.choice([None, "cat"]), rng.choice(["x", "y", None]), None, rng.choice([2015.5, None]), "clash") for i in range(400)]
    rows += [(999, 0, None, "dog", "x", None, 2015.0, "clash")]
    records = spark.createDataFrame(rows, "row_id long, load_id int, accession string, host_group string, country string, clade string, decimal_year double, category string")
    targets = spark.createDataFrame(TARGETS, "design_id int, dimension string, category string, target_share double, min_rows int, sample_size int")
    return records, targets


def test_unmet(tables):
    got = {(r.design_id, r.category, r.n_available) for r in unmet_targets(category_members(tables[0]), tables[1]).collect()}
    assert got == {(1, "seal", 10), (1, "newt", 0)}


def test_sample_meets_its_report(tables):
    members = category_members(tables[0])
    report = {(r.design_id, r.category): r for r in sample_report(members, tables[1]).collect()}
    rows = draw_samples(members, tables[1]).collect()
    assert Counter((r.design_id, r.category) for r in rows) == {k: r.n_drawn for k, r in report.items() if r.n_drawn}
    assert len({(r.design_id, r.accession) for r in rows}) == len(rows)
    assert (report[1, "seal"].n_drawn, report[1, "seal"].met, report[1, "newt"].n_drawn) == (10, False, 0)
    assert report[1, "dog"].n_drawn == 20 + 5 + 8
    assert report[2, "2010s"].n_drawn == 5 and report[2, "2010s"].met
    leaves = Counter(r.leaf for r in rows if r.category == "dog")
    assert max(leaves.values()) - min(leaves.values()) <= 1


def test_repeatable_and_empty(tables):
    members = category_members(tables[0])
    once, again = ({tuple(r) for r in draw_samples(members, tables[1]).collect()} for _ in range(2))
    assert once == again
    none = category_members(tables[0].where("false"))
    assert draw_samples(none, tables[1]).count() == 0
    assert unmet_targets(none, tables[1]).count() == len(TARGETS)
