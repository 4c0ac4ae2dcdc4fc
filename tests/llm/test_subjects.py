import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.subjects import SubjectSpec, document_subjects, leaf_terms

TERMS = {name: [f"{name[:2]}{c}x" for c in "bcdfghjklmnp"] for name in ("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "theta")}
FILLER = [f"fi{c}{d} mo{c}q plain{d} words{c} here" for c in "abcde" for d in "fghij"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    docs, truth, labels = [], {}, []
    for i in range(1500):
        subjects = rng.sample(sorted(TERMS), rng.choice([0, 1, 1, 2]))
        sentences = [f"we read of {rng.choice(TERMS[s])} and {rng.choice(TERMS[s])} at length" for s in subjects for _ in range(rng.choice([2, 3, 4]))]
        other = rng.choice([s for s in TERMS if s not in subjects])
        sentences += [f"a friend only talks about {rng.choice(TERMS[other])}"] * (rng.random() < 0.3) + rng.sample(FILLER, 4)
        rng.shuffle(sentences)
        docs.append((i, ". ".join(sentences) + ".", "en", "T: about", "clash"))
        truth[i] = set(subjects)
        if i % 6 == 0:
            labels += [(i, s, 1) for s in subjects] or [(i, "none", 1)]
    docs += [(1500, None, None, None, "c"), (1501, "", "en", "", "c"), (1502, " \n ", None, None, "c"), (1503, "bebx. " * 20_000, "en", None, "c")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, title string, subject string")
    return frame, spark.createDataFrame([(k, s) for k, s in enumerate(TERMS)], "subject_id int, subject string"), spark.createDataFrame(labels, "doc_id long, subject string, labeller int"), truth


def test_subjects_of_held_out_documents(tables):
    docs, subjects, labels, truth = tables
    got = {(r.doc_id, r.subject) for r in document_subjects(docs, subjects, labels, SubjectSpec(leaves=24)).collect()}
    held_out = {i for i in truth if i % 6}
    want = {(i, s) for i in held_out for s in truth[i]}
    found = {(i, s) for i, s in got if i in held_out}
    assert len(want & found) >= 0.97 * len(want) and len(want & found) >= 0.97 * len(found)
    assert not {i for i, _ in got} & {1500, 1501, 1502}
    assert (1503, "beta") in got


def test_leaf_terms(tables):
    rows = leaf_terms(*tables[:3], SubjectSpec(leaves=24)).collect()
    assert {r.subject for r in rows} >= set(TERMS)


def test_empty_tables(tables):
    docs, subjects, labels, _ = tables
    assert document_subjects(docs.where("false"), subjects, labels).count() == 0
    assert document_subjects(docs.where("text is null"), subjects, labels).count() == 0
    assert document_subjects(docs, subjects, labels.where("false"), SubjectSpec(leaves=6)).count() == 0


def test_subjects_come_from_the_leaves(tables, monkeypatch):
    docs, subjects, labels, truth = tables

    def by_chance(rows, spec):
        return rows.select("doc_id").distinct().select("doc_id", (F.abs(F.xxhash64("doc_id")) % 24).cast("int").alias("leaf")), np.eye(24)

    monkeypatch.setattr("tidemark.llm.subjects.document_leaves", by_chance)
    found = {(r.doc_id, r.subject) for r in document_subjects(docs, subjects, labels, SubjectSpec(leaves=24)).collect()}
    want = {(i, s) for i in truth for s in truth[i]}
    assert len(want & found) < 0.6 * len(want)
