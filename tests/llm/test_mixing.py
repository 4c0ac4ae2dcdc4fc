import random
from collections import Counter

import pytest

from tidemark.llm.mixing import mix_report, mix_sources, short_sources

TARGETS = [("a", 0.5, 1, 4000), ("b", 0.3, 3, 4000), ("c", 0.1, 2, 4000), ("none", 0.1, 5, 4000)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(2)
    rows = [(i, s, rng.randrange(0, 20)) for i, s in enumerate(rng.choices("abcd", [70, 6, 3, 5], k=900))]
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int, total_tokens long")
    return rows, spark.createDataFrame(rows, "key long, source string, n_tokens long"), targets


def test_short_sources(tables):
    rows, sizes, targets = tables
    held = Counter()
    for _, s, n in rows:
        held[s] += n
    assert {r.source for r in short_sources(sizes, targets).collect()} == {s for s, share, repeats, total in TARGETS if held[s] * repeats < share * total}


def test_mix(tables):
    rows, sizes, targets = tables
    report = {r.source: r for r in mix_report(sizes, targets).collect()}
    out = mix_sources(sizes, targets, depth=3).collect()
    drawn, uses = Counter(), Counter()
    for r in out:
        drawn[r.source] += r.n_tokens
        uses[r.source, r.key] += 1
    for s, share, repeats, total in TARGETS:
        assert drawn[s] == report[s].drawn and abs(drawn[s] - report[s].planned) <= 20
        assert all(n <= repeats for (src, _), n in uses.items() if src == s)
    assert len({(r.key, r["copy"]) for r in out}) == len(out)
    by_shard = Counter(r.shard for r in out)
    assert sorted(by_shard) == list(range(8)) and max(by_shard.values()) < 2 * min(by_shard.values())
    assert all(sorted(r.position for r in out if r.shard == s) == list(range(1, n + 1)) for s, n in by_shard.items())


def test_empty(tables):
    _, sizes, targets = tables
    assert mix_sources(sizes.where("false"), targets).count() == 0
    assert {r.source for r in short_sources(sizes.where("false"), targets).collect()} == {t[0] for t in TARGETS}
