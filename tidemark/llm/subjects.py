"""Subject areas of documents by clustering their vectors.

1. Topical words: words that, once a document uses them, come again in another
   sentence of it far more often than chance (burstiness within a language).
   Template and filler words don't; names of products do so even more, and are
   told by the titles they stand in.
2. Documents become normalised tf-idf vectors over topical words and are
   clustered by bisecting k-means.
3. Leaves get a mixture of subjects from the labelled documents they hold and from
   the leaves near them, and topical words a mixture from the leaves they stand in;
   the words with the greatest lift are the discriminative terms that label a leaf.
4. A sentence treats the subject that the mixtures of its words agree on. The
   mixtures of words are drawn once again from the sentences of their documents,
   so words that shared a leaf by chance fall to their own subject. ``none`` takes
   part as one more subject until the end, so words of advertising and the like
   don't fall to a real one.
5. A document has the subjects that at least two of its sentences treat.

Counts, vectors and leaves cover all documents. Only the subject mixture of a
leaf is fitted on the labelled ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed, if_small

NONE = "none"
SENTENCE_END = r"(?<=[.!?…])[\s\p{Z}]+|[\r\n]+"


@dataclass(frozen=True)
class SubjectSpec:
    leaves: int = 192
    iterations: int = 6
    features: int = 4096
    min_documents: int = 5
    burst: tuple[float, float] = (1.4, 15.0)
    title_share: float = 0.05
    divisible: float = 5.0
    prior_weight: float = 2.0
    nearness: float = 2.0
    vote: float = 2.0
    margin: float = 1.5
    min_sentences: int = 2
    rounds: int = 1
    seed: int = 3


def subject_names(subject_list: DataFrame) -> list[str]:
    """The subjects of the (short) list in order, and ``none``."""
    return [*sorted({r.subject for r in subject_list.select("subject").where("subject is not null").collect()} - {NONE}), NONE]


def word_sets(text: Column) -> Column:
    """The distinct words of every sentence: lower-case runs of two letters or more."""
    words = lambda s: F.array_distinct(F.filter(F.regexp_extract_all(s, F.lit(r"[\p{L}\p{M}]+"), F.lit(0)), lambda w: F.length(w) > 1))
    return F.transform(F.split(F.lower(text), SENTENCE_END), words)


def sentences(documents: DataFrame) -> DataFrame:
    """doc_id, lang, title words and ``sets`` (word sets by sentence) of documents with a text."""
    title = F.coalesce(F.array_distinct(F.flatten(word_sets(F.substring_index("title", ":", 1)))), F.array().cast("array<string>"))
    named = F.when(F.col("title").contains(":"), title).otherwise(F.array().cast("array<string>"))
    return documents.where("text is not null").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), named.alias("named"), word_sets(F.col("text")).alias("sets"))


def topical_words(docs: DataFrame, spec: SubjectSpec) -> DataFrame:
    """w, n_docs, burst of the topical words.

    burst is the share of a word's documents that use it in two sentences or
    more, over the greatest share of a language's documents that use it at all
    (languages with under one in a hundred documents aside; for words that only
    such a language uses, over their share of all documents).
    """
    flat = docs.select("lang", "named", F.sort_array(F.flatten("sets")).alias("all"))
    again = F.expr("array_distinct(filter(all, (x, i) -> i > 0 and all[i - 1] = x))")
    once, named = F.array_distinct("all"), F.array_intersect("named", "all")
    marked = lambda ws, k: F.transform(ws, lambda w: F.struct(w.alias("w"), F.lit(k).alias("k")))
    rows = flat.select("lang", F.explode(F.concat(marked(once, 1), marked(again, 2), marked(named, 3))).alias("x")).select("lang", "x.w", "x.k")
    stats = rows.groupBy("w", "lang").agg(*(F.count_if(F.col("k") == k).alias(c) for k, c in ((1, "n1"), (2, "n2"), (3, "nt"))))
    sizes = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("nl"))
    sizes = checkpointed(sizes.withColumn("all", F.sum("nl").over(Window.partitionBy())))
    rate = F.coalesce(F.max(F.when(F.col("nl") * 100 >= F.col("all"), F.col("n1") / F.col("nl"))), F.sum("n1") / F.max("all"))
    words = stats.join(if_small(sizes), "lang").groupBy("w").agg(F.sum("n1").alias("n_docs"), F.sum("n2").alias("n2"), F.sum("nt").alias("nt"), rate.alias("rate"))
    words = words.withColumn("burst", F.col("n2") / (F.col("n_docs") + 2) / F.col("rate"))
    return words.where((F.col("n_docs") >= spec.min_documents) & F.col("burst").between(*spec.burst) & (F.col("nt") <= spec.title_share * F.col("n_docs"))).select("w", "n_docs", "burst")


def topical_rows(docs: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id, pos, w: topical words of every sentence."""
    rows = docs.select("doc_id", F.posexplode("sets").alias("pos", "ws")).select("doc_id", "pos", F.explode("ws").alias("w"))
    return rows.join(if_small(words.select("w")), "w")


def document_leaves(rows: DataFrame, spec: SubjectSpec) -> tuple[DataFrame, np.ndarray]:
    """doc_id, leaf by bisecting k-means over normalised tf-idf vectors of topical words, and the cosines between the leaves' centres."""
    bags = rows.groupBy("doc_id").agg(F.collect_list("w").alias("words"))
    counted = checkpointed(HashingTF(inputCol="words", outputCol="tf", numFeatures=spec.features).transform(bags).select("doc_id", "tf"))
    weighted = IDF(inputCol="tf", outputCol="weighted").fit(counted).transform(counted)
    # Every pass of the clustering reads the vectors; a part that is lost comes again from the checkpoint.
    vectors = Normalizer(inputCol="weighted", outputCol="features").transform(weighted).select("doc_id", "features").persist(StorageLevel.DISK_ONLY)
    model = BisectingKMeans(k=spec.leaves, maxIter=spec.iterations, seed=spec.seed, minDivisibleClusterSize=spec.divisible).fit(vectors)
    leaves = checkpointed(model.transform(vectors).select("doc_id", F.col("prediction").alias("leaf")))
    vectors.unpersist()
    centres = np.array(model.clusterCenters())
    centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return leaves, np.clip(centres @ centres.T, 0.0, 1.0)


def leaf_mixtures(leaves: DataFrame, near: np.ndarray, labels: DataFrame, subjects: list[str], spec: SubjectSpec) -> DataFrame:
    """leaf, p_0 .. : shares of the subjects among the labelled documents of a leaf.

    Shares are drawn to those of the leaves whose centres are near, and these to
    the overall shares, so a leaf without a label has the subjects of its
    neighbours. The counts are of leaves by subjects, both few.
    """
    marks = labels.select("doc_id", "subject").distinct().where(F.col("subject").isin(*subjects))
    counted = leaves.join(marks, "doc_id").groupBy("leaf", "subject").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros((len(near), len(subjects)))
    for r in counted.collect():
        counts[r.leaf, subjects.index(r.subject)] = r.n
    prior = counts.sum(0) / max(counts.sum(), 1.0)
    around = (near**spec.nearness) @ counts
    around = (around + spec.prior_weight * prior * 0.1) / (around.sum(1, keepdims=True) + spec.prior_weight * 0.1)
    shares = (counts + spec.prior_weight * around) / (counts.sum(1, keepdims=True) + spec.prior_weight)
    return leaves.sparkSession.createDataFrame([(k, *map(float, row)) for k, row in enumerate(shares)], "leaf int, " + ", ".join(f"p_{i} double" for i in range(len(subjects))))


def term_lifts(terms: DataFrame, subjects: list[str]) -> DataFrame:
    """w, v_0 .. : log lift of each subject, from n and the sums s_0 .. of mixtures by word (``terms`` is read twice)."""
    k = range(len(subjects))
    whole = terms.agg(F.sum("n").alias("n"), *(F.sum(f"s_{i}").alias(f"s_{i}") for i in k)).first()
    prior = [(whole[f"s_{i}"] or 0.0) / (whole["n"] or 1) for i in k]
    return terms.select("w", *(F.log((F.col(f"s_{i}") / F.col("n") + 0.02) / (prior[i] + 0.02)).alias(f"v_{i}") for i in k))


def leaf_term_sums(pairs: DataFrame, leaves: DataFrame, mixtures: DataFrame, subjects: list[str]) -> DataFrame:
    """w, n, s_0 .. : documents of a word and the sums of the mixtures of their leaves."""
    per_leaf = pairs.join(leaves, "doc_id").groupBy("w", "leaf").agg(F.count(F.lit(1)).alias("n"))
    sums = (F.sum(F.col("n") * F.col(f"p_{i}")).alias(f"s_{i}") for i in range(len(subjects)))
    return per_leaf.join(if_small(mixtures), "leaf").groupBy("w").agg(F.sum("n").alias("n"), *sums)


def vote_term_sums(pairs: DataFrame, votes: DataFrame, subjects: list[str]) -> DataFrame:
    """w, n, s_0 .. : documents of a word that have votes, and the sums of their shares of votes."""
    k = range(len(subjects))
    shares = votes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("all"), *(F.count_if(F.col("subject") == s).alias(f"c_{i}") for i, s in enumerate(subjects)))
    shares = shares.select("doc_id", *((F.col(f"c_{i}") / F.col("all")).alias(f"p_{i}") for i in k))
    return pairs.join(shares, "doc_id").groupBy("w").agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"p_{i}").alias(f"s_{i}") for i in k))


def sentence_subjects(rows: DataFrame, terms: DataFrame, subjects: list[str], spec: SubjectSpec) -> DataFrame:
    """doc_id, pos, subject: sentences whose words agree on one subject."""
    k = range(len(subjects))
    summed = rows.join(if_small(terms), "w").groupBy("doc_id", "pos").agg(*(F.sum(f"v_{i}").alias(f"v_{i}") for i in k))
    ranked = F.sort_array(F.array(*(F.struct(F.col(f"v_{i}").alias("v"), F.lit(s).alias("subject")) for i, s in enumerate(subjects))), asc=False)
    best = summed.select("doc_id", "pos", ranked.alias("r"))
    sure = (F.col("r")[0]["v"] >= F.log(F.lit(spec.vote))) & (F.col("r")[0]["v"] - F.get("r", F.lit(1))["v"] >= F.log(F.lit(spec.margin)))
    return best.where(sure).select("doc_id", "pos", F.col("r")[0]["subject"].alias("subject"))


def document_subjects(documents: DataFrame, subject_list: DataFrame, labels: DataFrame, spec: SubjectSpec = SubjectSpec()) -> DataFrame:
    """doc_id, subject, n_sentences: the subjects that at least two sentences of a text treat.

    Documents without a text, or without such a subject, have no rows. The title
    doesn't count. An empty table, or one without labels or topical words, gives
    no rows. ``subject_list`` is short (it names the columns of the mixtures).
    """
    subjects = subject_names(subject_list)
    docs = sentences(documents)
    words = checkpointed(topical_words(docs, spec))
    rows = checkpointed(topical_rows(docs, words))
    if len(subjects) < 2 or rows.isEmpty():
        return documents.sparkSession.createDataFrame([], documents.select("doc_id").schema.add("subject", "string").add("n_sentences", "long"))
    leaves, near = document_leaves(rows, spec)
    pairs = checkpointed(rows.select("doc_id", "w").distinct())
    sums = checkpointed(leaf_term_sums(pairs, leaves, leaf_mixtures(leaves, near, labels, subjects, spec), subjects))
    for _ in range(spec.rounds):
        votes = sentence_subjects(rows, term_lifts(sums, subjects), subjects, spec)
        sums = checkpointed(vote_term_sums(pairs, votes, subjects))
    votes = sentence_subjects(rows, term_lifts(sums, subjects), subjects, spec).where(F.col("subject") != NONE)
    return votes.groupBy("doc_id", "subject").agg(F.count(F.lit(1)).alias("n_sentences")).where(F.col("n_sentences") >= spec.min_sentences)


def leaf_terms(documents: DataFrame, subject_list: DataFrame, labels: DataFrame, spec: SubjectSpec = SubjectSpec(), top: int = 8) -> DataFrame:
    """leaf, n_docs, subject, share, terms: every leaf with its main subject and most discriminative words.

    A word's weight is its share of the leaf's documents over its share of all.
    """
    subjects = subject_names(subject_list)
    docs = sentences(documents)
    rows = checkpointed(topical_rows(docs, checkpointed(topical_words(docs, spec))))
    leaves, near = document_leaves(rows, spec)
    mixtures = leaf_mixtures(leaves, near, labels, subjects, spec)
    main = F.array_max(F.array(*(F.struct(F.col(f"p_{i}").alias("share"), F.lit(s).alias("subject")) for i, s in enumerate(subjects))))
    counts = rows.select("doc_id", "w").distinct().join(leaves, "doc_id").groupBy("leaf", "w").agg(F.count(F.lit(1)).alias("n"))
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = checkpointed(counts)
    whole = counts.agg(F.sum("n")).first()[0] or 1
    lift = F.col("n") * F.log(F.col("n") / F.col("n_docs") / (F.sum("n").over(Window.partitionBy("w")) / whole))
    ranked = counts.join(sizes, "leaf").withColumn("weight", lift).withColumn("r", F.row_number().over(Window.partitionBy("leaf").orderBy(F.desc("weight"), "w"))).where(F.col("r") <= top)
    terms = ranked.groupBy("leaf", "n_docs").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "w"))), lambda x: x["w"]), " ").alias("terms"))
    return terms.join(mixtures.select("leaf", main.alias("m")), "leaf").select("leaf", "n_docs", "m.subject", "m.share", "terms")
