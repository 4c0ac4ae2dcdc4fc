import base64
import random

import pytest

from tidemark.llm.encode import PATTERN, TOKENIZERS, Vocabulary, encoded, token_count

tiktoken = pytest.importorskip("tiktoken")
PATH = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(8)
    make = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    return ["", " ", "\n\n  x", "<|endoftext|>", "a" * 3000, " " * 900, "ß漢字🎉 é é", "it's I'LL we'd"] + [make(rng.randrange(900), a) for a in ("ab", "the quick brown ", "aé漢🎉\n\t 1'", "ACGT") for _ in range(25)]


def test_matrices_equal_the_library(library):
    got = list(Vocabulary(PATH).encode(texts()))
    assert got == [library.encode_ordinary(t) for t in texts()]


def test_long_pieces(library):
    rng = random.Random(3)
    pieces = ["".join(rng.choice(a) for _ in range(n)) for a in ("ab", "abcdefghijklmnopqrstuvwxyz", "aé漢") for n in (513, 5000)]
    pieces += ["a" * 1_000_000, "".join(rng.choice("acgt") for _ in range(100_000))]
    assert list(Vocabulary(PATH).encode(pieces)) == [library.encode_ordinary(t) for t in pieces]


def test_other_vocabulary_round_trip():
    path = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    back = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(path, "rb"))}
    for text, ids in zip(texts(), Vocabulary(path).encode(texts()), strict=True):
        assert b"".join(back[i] for i in ids).decode() == text


def test_tables_nulls_and_counts(spark, library):
    rows = [(1, None, "clash"), (2, "", "x"), (3, "hello world", "x"), (3, "hello world", "x"), (4, "word " * 60_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id, list(r.ids)) for r in encoded(df).collect())
    assert got == sorted((k, library.encode_ordinary(t or "")) for k, t, _ in rows)
    assert sorted(r[0] for r in df.select(token_count(df.text)).collect()) == sorted(len(library.encode_ordinary(t or "")) for _, t, _ in rows)
    assert encoded(df.where("false")).count() == 0
