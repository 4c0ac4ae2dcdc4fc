import pytest
from pyspark.sql import functions as F

from tidemark.operators.chains import effective_sizes
from tidemark.operators.newick import annotation_map, decoded, state_tag, tree_nodes
from tidemark.sources import burnt_trees, read_anchors, read_patterns, read_rules, read_text_columns, states_from_labels, write_table_text
from tidemark.sources import read_chain_log, read_fasta, read_records, read_table_text, read_trees, write_chain_log, write_fasta


def test_fasta_round_trip(spark, tmp_path):
    rows = [("a", "ACGT" * 50), ("b", ""), ("c", "acgt-N" * 10)]
    write_fasta(spark.createDataFrame(rows, "name string, seq string"), str(tmp_path / "f"))
    assert sorted((r.name, r.seq) for r in read_fasta(spark, str(tmp_path / "f")).collect()) == rows
    (tmp_path / "x.fa").write_text(">k1 some words\r\nAC\r\nGT\r\n>k2\nTT\n")
    assert sorted(map(tuple, read_fasta(spark, str(tmp_path / "x.fa")).collect())) == [("k1", "some words", "ACGT"), ("k2", "", "TT")]


def test_chain_log_drops_what_does_not_fit(spark, tmp_path):
    (tmp_path / "a.log").write_text("# note\nSample\tp\tq\n0\t1.5\t2\n10\tx\t2\n20\t2.5\n30\t3.5\t4\n40\t1")
    got = read_chain_log(spark, str(tmp_path / "a.log"))
    assert sorted((r["sample"], r.param, r.value) for r in got.collect()) == [(0, "p", 1.5), (0, "q", 2.0), (30, "p", 3.5), (30, "q", 4.0)]
    write_chain_log(got, str(tmp_path / "out"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_nexus_trees(spark, tmp_path):
    (tmp_path / "t.nex").write_text("#NEXUS\nBegin trees;\nTranslate\n 1 Alpha,\n 2 'Beta'\n;\ntree STATE_0 = [&R] ((1:1,2:2):1,3:1);\nEnd;\n")
    assert [(r.tree, r.newick) for r in read_trees(spark, str(tmp_path / "t.nex")).collect()] == [("STATE_0", "((Alpha:1,Beta:2):1,3:1);")]


def test_tables_and_records(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("name\tn\n# note\na\t1\nb\tx\n")
    assert [tuple(r) for r in read_table_text(spark, str(tmp_path / "t.tsv"), "name string, n int").collect()] == [("a", 1)]
    (tmp_path / "r.gb").write_text('LOCUS       X\nDEFINITION  some\n            virus.\nVERSION     X1.1\nFEATURES\n     source          1..8\n                     /host="a\n                     b"\n                     /host="c"\n     gene            1..3\n                     /gene="g"\nORIGIN\n        1 acgt acgt\n//\n')
    row = read_records(spark, str(tmp_path / "r.gb")).first()
    assert (row.accession, row.definition.strip(), row.seq, row.qualifiers) == ("X1.1", "some virus.", "ACGTACGT", {"host": "a b"})


def test_effective_size_of_ar1_and_blocks(spark):
    import numpy as np

    rng, rho, n = np.random.default_rng(4), 0.8, 20_000
    x = np.zeros(n)
    for i in range(1, n):
        x[i] = rho * x[i - 1] + rng.normal()
    df = spark.createDataFrame([("c", i, float(v)) for i, v in enumerate(x)], "chain string, i long, v double")
    whole, cut = (effective_sizes(df, "chain", "i", "v", 500, b).first().ess for b in (50_000, 3_000))
    assert abs(whole - cut) < 1e-6 * whole
    assert abs(whole / (n * (1 - rho) / (1 + rho)) - 1) < 0.25


def test_rule_and_pattern_tables(spark, tmp_path):
    (tmp_path / "rules.tsv").write_text("# rules\nred fox\tVulpes vulpes\twild\n\ndog\tCanis familiaris\tdomestic\textra\n")
    assert [tuple(r) for r in read_rules(spark, str(tmp_path / "rules.tsv")).orderBy("lineno").collect()] == [(2, "red fox", "Vulpes vulpes", "wild"), (4, "dog", "Canis familiaris", "domestic")]
    (tmp_path / "short.tsv").write_text("a\tb\tc\nonly\tone\n")
    with pytest.raises(ValueError, match="line 2"):
        read_rules(spark, str(tmp_path / "short.tsv"))
    (tmp_path / "none.tsv").write_text("# nothing\n")
    with pytest.raises(ValueError, match="no rules"):
        read_rules(spark, str(tmp_path / "none.tsv"))
    (tmp_path / "p.txt").write_text("Strain A\n# no\n\n LAB 7 \n")
    assert [tuple(r) for r in read_patterns(spark, str(tmp_path / "p.txt")).orderBy("lineno").collect()] == [(1, "strain a"), (4, "lab 7")]


def test_text_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("accession\ttype\tlineage\nAB1.2\tnuc\tL1\nAB2\tprot\tL2\nAB3\tnuc\t\n")
    assert [tuple(r) for r in read_text_columns(spark, str(tmp_path / "a.tsv")).collect()][2] == ("AB3", "nuc", "")
    assert {tuple(r) for r in read_anchors(spark, str(tmp_path / "a.tsv")).collect()} == {("AB1", "L1"), ("AB3", "")}
    assert {r.accession for r in read_anchors(spark, str(tmp_path / "a.tsv"), versions=True).collect()} == {"AB1.2", "AB3"}
    (tmp_path / "n.tsv").write_text("name\tn\na\t1\nb\tx\n")
    assert [(r.name, r.n, r._corrupt is None) for r in read_table_text(spark, str(tmp_path / "n.tsv"), "name string, n int", keep_broken=True).cache().collect()] == [("a", 1, True), ("b", None, False)]
    rows = spark.createDataFrame([("x", 1.23456, None), ("y", 2.0, "q")], "g string, v double, t string")
    write_table_text(rows, str(tmp_path / "out"), by=["g"], digits={"v": 3})
    assert sorted((r.g, r.v, r.t) for r in spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "out")).collect()) == [("x", "1.235", None), ("y", "2.000", "q")]


def test_labels_and_burnin(spark):
    tips = spark.createDataFrame([("a|wild|2001",), ("b",), ("c||2",)], "name string")
    assert [r.state for r in states_from_labels(tips, 1).orderBy("name").collect()] == ["wild", None, None]
    trees = spark.createDataFrame([(c, f"STATE_{k * 1000}", "(a,b);") for c in "xy" for k in range(20)], "chain string, tree string, newick string")
    kept = sorted((r.chain, int(r.tree[6:])) for r in burnt_trees(trees, 0.1, 3).collect())
    assert kept == [(c, k * 1000) for c in "xy" for k in range(2, 20, 3)]
    assert burnt_trees(trees, 0.1, 3, cap=5).groupBy("chain").count().where("count = 3").count() == 2


def test_annotations(spark):
    texts = [("t", '((a[&host="dog",rate=0.1,host.set={"dog","cat"}]:1,b[&host="cat",rate=0.2]:2)[&rate=0.3]:1,c[&host="dog"]:1);')]
    nodes = tree_nodes(spark.createDataFrame(texts, "tree string, newick string"), "tree", "newick")
    entries = {r.label: r.m for r in nodes.where("label is not null").select("label", annotation_map(F.col("annotation")).alias("m")).collect()}
    assert entries["b"] == {"&host": "cat", "rate": "0.2"} or entries["b"] == {"host": "cat", "rate": "0.2"}
    assert state_tag(nodes) == "host" and state_tag(nodes, "rate") == "rate" and state_tag(nodes.where("false")) is None
    assert [r[0] for r in spark.createDataFrame([("0",), ("7",)], "s string").select(decoded(F.col("s"), "dog=0,cat=1")).collect()] == ["dog", "7"]
