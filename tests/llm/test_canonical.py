import random
from functools import cache

import pytest

from tidemark.llm.canonical import candidate_pairs, canonical_values, pigeonhole_matches, word_segments

RULES = [
    (1, "vulpo rubra", "Vulpo rubra", "wild"), (2, "red foxel", "Vulpo rubra", "wild"), (3, "vulpo nigrella", "Vulpo nigrella", "wild"), (4, "long-eared foxel", "Vulpo nigrella", "wild"),
    (5, "felix domestrica", "Felix domestrica", "home"), (6, "foxel mousard", "Murina foxelis", "rodent"), (7, "whiskertail", "Felix domestrica", "home"),
    (8, "vulpo", "Vulpo sp.", "wild"), (9, "foxel", "Vulpo sp.", "wild"), (10, "mousard", "Murina sp.", "rodent"), (11, "red foxel", "Felix domestrica", "home"),
]
CASES = {
    "Vulpo rubra": "Vulpo rubra", "VULPO_RUBRA (captive)": "Vulpo rubra", "vulpo rbura": "Vulpo rubra", "red foxels": "Vulpo rubra", "foxel, red": "Vulpo rubra", "redfoxel": "Vulpo rubra", "réd föxel": "Vulpo rubra", "red f0xel": "Vulpo rubra",
    "V. rubra": "Vulpo rubra", "v_rubra": "Vulpo rubra", "long-eared foxel": "Vulpo nigrella", "foxel, long-eared": "Vulpo nigrella", "Vulpo nigrella (long-eared foxel)": "Vulpo nigrella", "red foxel; lung tissue": "Vulpo rubra",
    "foxel mousard": "Murina foxelis", "wild Vulpo": "Vulpo sp.", "Vulpo sp.": "Vulpo sp.", "Vulpo strangeivora": "Vulpo sp.", "spotted foxel": "Vulpo sp.", "Vulpo rubra albanis": "Vulpo rubra", "whiskertial": "Felix domestrica",
    "foxelbird": None, "underfoxel": None, "seafoxelfish": None, "brain tissue": None, "": None, " ": None, "?": None, "12": None, None: None, "red foxel and whiskertail": None, "Vulpo rubra / Vulpo nigrella": None, "Lunneops strangeita": None,
    "x " * 20_000 + "red foxel": "Vulpo rubra",
}


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "lineno int, pattern string, canonical string, host_group string")


def test_cases(spark, rules):
    rows = [(i, t, "clash", 1) for i, t in enumerate(CASES)]
    df = spark.createDataFrame(rows, "host_id long, host_raw string, canonical string, pos int")
    got = {r.host_id: r for r in canonical_values(df, rules).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        assert got[i].canonical == CASES[t], t
        assert got[i].ambiguous == (CASES[t] is None)
    reasons = {t: got[i].reason for i, t, *_ in rows}
    assert (reasons[None], reasons["12"], reasons["red foxel and whiskertail"], reasons["red foxel"] if "red foxel" in reasons else None) == ("empty", "unmatched", "several", None)


def test_empty_table_and_repeats(spark, rules):
    schema = "host_id long, host_raw string"
    assert canonical_values(spark.createDataFrame([], schema), rules).count() == 0
    assert [r.canonical for r in canonical_values(spark.createDataFrame([(1, "red foxel"), (1, "red foxel")], schema), rules).collect()] == ["Vulpo rubra"] * 2


def test_pigeonhole_loses_no_pair(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcde") for _ in range(rng.choice([*range(1, 13), 45, 60]))) for _ in range(60)]

    def typo(w):
        i = rng.randrange(max(len(w), 1))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcde") + w[i:], w[:i] + rng.choice("abcde") + w[i + 1 :], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]])

    tokens = {typo(w) for w in words for _ in range(4)} | {typo(typo(w)) for w in words for _ in range(4)} | set(words)
    tokens.discard("")

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    @cache
    def ball(w):
        """w and all that one typing error makes of it."""
        places = range(len(w) + 1)
        return {w} | {w[:i] + w[i + 1 :] for i in places} | {w[:i] + c + w[j:] for i in places for j in (i, i + 1) for c in "abcdes"} | {w[:i] + w[i : i + 2][::-1] + w[i + 2 :] for i in places}

    def accepted(w, t):
        k = 2 if len(w) >= 6 else 1 if len(w) >= 3 else 0
        near = abs(len(w) - len(t)) <= k and (w == t or (k == 1 and t in ball(w)) or (k == 2 and not ball(w).isdisjoint(ball(t))))
        return 0 if t == w + "s" else lev(w, t) if near else None

    wanted = {}
    for t in tokens:
        near = {w: accepted(w, t) for w in set(words) if accepted(w, t) is not None}
        if near:
            wanted[t] = {w for w, d in near.items() if d == min(near.values())}
    assert max(map(len, wanted)) > 58
    df = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    got = {r.token: set(r.words) for r in pigeonhole_matches(df(tokens, "token"), df(set(words), "word")).collect()}
    assert got == wanted


def test_no_one_letter_segments_and_few_candidates(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 30))) for _ in range(200)]
    df = lambda xs, c: spark.createDataFrame([(x,) for x in set(xs)], f"{c} string")
    short = [(r.word, r.seg) for r in word_segments(df(words, "word")).collect() if len(r.seg) < 2]
    assert all(len(w) <= 2 for w, _ in short)
    tokens = [w[:3] + w[4:] for w in words if len(w) > 5] + words
    assert candidate_pairs(df(tokens, "token"), df(words, "word")).distinct().count() < 10 * len(tokens)


def test_repeated_and_null_keys_keep_their_own_texts(spark, rules):
    df = spark.createDataFrame([(1, "red foxel"), (1, "whiskertail"), (None, "mousard"), (2, None)], "host_id long, host_raw string")
    assert sorted((r.host_id or 0, r.canonical or r.reason) for r in canonical_values(df, rules).collect()) == [(0, "Murina sp."), (1, "Felix domestrica"), (1, "Vulpo rubra"), (2, "empty")]
