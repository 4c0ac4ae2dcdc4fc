"""Text formats of the domain, read and written with Spark's own readers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.ranks import value_rank


def read_fasta(spark: SparkSession, path: str, upper: bool = False) -> DataFrame:
    """name (the first word of the header), description, seq. Blank records are skipped; gzip by suffix."""
    records = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    lines = F.split(F.regexp_replace("value", "\r", ""), "\n")
    seq = F.regexp_replace(F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), ""), r"\s", "")
    return records.select(F.split(lines[0], r"\s")[0].alias("name"), F.trim(F.regexp_replace(lines[0], r"^\S*", "")).alias("description"), (F.upper(seq) if upper else seq).alias("seq"))


def write_fasta(rows: DataFrame, path: str, width: int = 60) -> None:
    """Rows with name and seq as FASTA, lines of ``width`` characters."""
    body = F.regexp_replace(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), "\n$", "")
    rows.select(F.concat(F.lit(">"), F.col("name").cast("string"), F.lit("\n"), body).alias("value")).write.mode("overwrite").text(path)


def read_table_text(spark: SparkSession, path: str, schema: str, keep_broken: bool = False) -> DataFrame:
    """A tab-separated table with a header and # comments.

    Rows that don't fit the schema are dropped, or with ``keep_broken`` kept with
    their text in ``_corrupt``, which is null in the others.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("comment", "#")
    if not keep_broken:
        return reader.option("mode", "DROPMALFORMED").schema(schema).csv(path)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(f"{schema}, _corrupt string").csv(path)


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a header, every column as text and '' where nothing stands."""
    return spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path).na.fill("")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """lineno (from 1), value: the lines of one short file in their order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r\n|\n")).alias("i", "value")).select((F.col("i") + 1).alias("lineno"), "value")


def read_rules(spark: SparkSession, path: str, fields: tuple[str, ...] = ("pattern", "canonical", "host_group")) -> DataFrame:
    """lineno and ``fields`` of an ordered rule table; blank lines and # comments are skipped but counted.

    A line with too few fields, or a table without rules, is an error: the rules
    after it would silently mean something else.
    """
    lines = numbered_lines(spark, path).where("trim(value) <> '' and not startswith(ltrim(value), '#')").select("lineno", F.split("value", "\t").alias("c"))
    short = lines.where(F.size("c") < len(fields)).agg(F.min("lineno")).first()[0]
    if short is not None:
        raise ValueError(f"{path}, line {short}: fewer than {len(fields)} fields")
    if lines.isEmpty():
        raise ValueError(f"{path} has no rules")
    return lines.select("lineno", *(F.trim(F.col("c")[k]).alias(f) for k, f in enumerate(fields)))


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """lineno, pattern: a list of patterns in lower case; blank lines and # comments are skipped."""
    return numbered_lines(spark, path).select("lineno", F.lower(F.trim("value")).alias("pattern")).where("pattern <> '' and not startswith(pattern, '#')")


def read_anchors(spark: SparkSession, path: str, kind: str = "nuc", versions: bool = False) -> DataFrame:
    """accession, lineage of the rows of a ``kind`` in a tab-separated reference table with these columns; without versions unless asked for."""
    rows = read_text_columns(spark, path).where(F.col("type") == kind)
    accession = F.trim("accession") if versions else F.split(F.trim("accession"), r"\.")[0]
    return rows.select(accession.alias("accession"), F.trim("lineage").alias("lineage")).where("accession <> ''")


def states_from_labels(tips: DataFrame, field: int, sep: str = "|") -> DataFrame:
    """name, state: the field of each label, counted from 0; null where a label has too few."""
    return tips.select("name", F.nullif(F.get(F.split("name", re.escape(sep)), F.lit(field)), F.lit("")).alias("state"))


def write_table_text(rows: DataFrame, path: str, by: list[str] | None = None, digits: dict[str, int] | None = None) -> None:
    """Rows as tab-separated texts with a header, nulls empty; ``by`` splits into folders, ``digits`` fixes decimals of columns."""
    shaped = rows.withColumns({c: F.format_string(f"%.{n}f", F.col(c).cast("double")) for c, n in (digits or {}).items()})
    writer = shaped.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "")
    (writer.partitionBy(*by) if by else writer).csv(path)


def burnt_trees(trees: DataFrame, burnin: float = 0.1, thin: int = 1, cap: int | None = None) -> DataFrame:
    """Trees (chain, tree, newick) without the first share of each chain, every ``thin``-th of the rest, at most an even part of ``cap`` a chain.

    Trees are taken in the order of the numbers in their names. Choose before
    parsing: what is left out is never parsed.
    """
    numbered = trees.withColumn("_no", F.coalesce(F.regexp_extract("tree", r"(\d+)$", 1).try_cast("long"), F.lit(0)))
    ranked = value_rank(numbered, ["chain"], "_no", "tree", "_r").join(trees.groupBy("chain").agg(F.count(F.lit(1)).alias("_size")), "chain")
    place = F.col("_r") - 1 - F.bround(F.col("_size") * burnin)
    kept = ranked.where((place >= 0) & (place % thin == 0)).withColumn("idx", place / thin)
    if cap is not None:
        chains = trees.select("chain").distinct().count() or 1
        kept = kept.where(F.col("idx") < -(-cap // chains))
    return kept.select(*trees.columns)


def read_chain_log(spark: SparkSession, path: str) -> DataFrame:
    """chain (the file), sample, param, value of sampler logs: # comments, a header that starts with the sample column.

    Lines with another number of fields than their header, or a field that is no
    number, are dropped (a log that is still written ends in one).
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("chain"), F.col("value")).where("value <> '' and not startswith(value, '#')")
    cells = lines.select("chain", F.split("value", "\t").alias("c"))
    is_head = F.col("c")[0].try_cast("double").isNull()
    heads = cells.where(is_head).groupBy("chain").agg(F.first("c").alias("h"))
    rows = cells.where(~is_head).join(heads, "chain").where(F.size("c") == F.size("h"))
    rows = rows.where(F.forall("c", lambda x: x.try_cast("double").isNotNull()))
    values = rows.select("chain", F.col("c")[0].try_cast("long").alias("sample"), F.explode(F.arrays_zip(F.expr("slice(h, 2, size(h) - 1)").alias("param"), F.expr("slice(c, 2, size(c) - 1)").alias("value"))).alias("x"))
    return values.select("chain", "sample", "x.param", F.col("x.value").try_cast("double").alias("value"))


def write_chain_log(rows: DataFrame, path: str) -> None:
    """Pooled chains (chain, sample, param, value) as one wide table by chain and sample, samples numbered anew in each chain."""
    wide = rows.groupBy("chain", "sample").pivot("param").agg(F.first("value"))
    renumbered = wide.withColumn("sample", F.row_number().over(Window.partitionBy("chain").orderBy("sample")) - 1)
    renumbered.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """chain (the file), tree (its name), newick of NEXUS tree lines, labels of the Translate block put in.

    Of plain files every line that starts with a bracket is a tree. Translate
    tables are small and joined by file.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("chain"), F.trim("value").alias("v")).where("v <> ''")
    named = F.regexp_extract("v", r"(?i)^tree\s+([^\s=\[]+)[^=]*=\s*(?:\[[^\]]*\]\s*)?(.*)$", 1)
    body = F.regexp_extract("v", r"(?i)^tree\s+([^\s=\[]+)[^=]*=\s*(?:\[[^\]]*\]\s*)?(.*)$", 2)
    trees = lines.select("chain", F.when(named != "", named).otherwise("").alias("tree"), F.when(named != "", body).when(F.col("v").startswith("("), F.col("v")).alias("newick")).where("newick is not null")
    entry = F.regexp_extract("v", r"^(\d+)\s+'?([^',;]+)'?\s*[,;]?$", 1), F.regexp_extract("v", r"^(\d+)\s+'?([^',;]+)'?\s*[,;]?$", 2)
    translate = lines.select("chain", entry[0].alias("k"), entry[1].alias("label")).where("k <> ''").groupBy("chain").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("k", "label")))).alias("t"))
    joined = trees.join(translate, "chain", "left")
    parts = F.regexp_extract_all("newick", F.lit(r"([(,])(\d+)(?=[:,)\[])|([^(,]+|[(,])"), F.lit(0))
    put = F.transform(parts, lambda p: F.when(p.rlike(r"^[(,]\d+$"), F.concat(F.substring(p, 1, 1), F.coalesce(F.try_element_at("t", p.substr(F.lit(2), F.length(p))), p.substr(F.lit(2), F.length(p))))).otherwise(p))
    return joined.select("chain", "tree", F.when(F.col("t").isNotNull(), F.array_join(put, "")).otherwise(F.col("newick")).alias("newick"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """accession, definition, seq, qualifiers (first source feature) of flat-file records that end in //."""
    text = spark.read.option("lineSep", "//\n").text(path).where("value rlike '(?m)^LOCUS'")
    pick = lambda p: F.regexp_extract("value", p, 1)
    source = pick(r"(?ms)^     source\s+\S+\n(.*?)(?=^     \S|^ORIGIN|\z)")
    pairs = F.regexp_extract_all(source, F.lit(r'(?s)/(\w+)="([^"]*)"'), F.lit(0))
    split = lambda x, k: F.regexp_replace(F.regexp_extract(x, r'(?s)/(\w+)="([^"]*)"', k), r"\s+", " ")
    firsts = F.aggregate(pairs, F.expr("cast(map() as map<string,string>)"), lambda m, x: F.when(F.map_contains_key(m, split(x, 1)), m).otherwise(F.map_concat(m, F.create_map(split(x, 1), split(x, 2)))))
    seq = F.upper(F.regexp_replace(pick(r"(?s)ORIGIN[^\n]*\n(.*)"), r"[\s\d/]", ""))
    return text.select(pick(r"(?m)^VERSION\s+(\S+)").alias("accession"), F.regexp_replace(pick(r"(?ms)^DEFINITION\s+(.*?)(?=^\S)"), r"\s+", " ").alias("definition"), seq.alias("seq"), firsts.alias("qualifiers"))
