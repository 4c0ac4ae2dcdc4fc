"""Newick texts to node rows and back.

Parsing is a small helper per text inside Arrow batches; everything on the
nodes is DataFrame work (``operators.trees``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"""\s*(\[[^\]]*\]|'(?:[^']|'')*'|[(),;:]|[^\s()\[\],;:']+)""")
NODE_SCHEMA = "node int, parent int, label string, length double, n_children int, annotation string"


def parse_nodes(text: str | None) -> Iterator[tuple]:
    """Nodes of one tree in pre-order: node, parent, label, length, n_children, annotation.

    Iterative, so depth has no limit. Quotes and [..] comments may hold brackets
    and commas; a comment behind a node is its annotation. A text that is no tree
    (null, unbalanced) has no nodes.
    """
    rows: list[list] = [[0, None, None, None, 0, None]]
    here, closed, want_length, depth, seen = 0, False, False, 0, False
    for token in TOKEN.findall(text or ""):
        if token == ";":
            break
        seen = True
        if token == "(":
            depth += 1
            rows[here][4] += 1
            rows.append([len(rows), here, None, None, 0, None])
            here = len(rows) - 1
        elif token == ",":
            if depth == 0:
                return
            here = rows[here][1]
            rows[here][4] += 1
            rows.append([len(rows), here, None, None, 0, None])
            here = len(rows) - 1
        elif token == ")":
            if depth == 0:
                return
            depth -= 1
            here = rows[here][1]
        elif token == ":":
            want_length = True
            continue
        elif token.startswith("["):
            rows[here][5] = (rows[here][5] or "") + token[1:-1]
        elif want_length:
            try:
                rows[here][3] = float(token)
            except ValueError:
                return
        else:
            rows[here][2] = token[1:-1].replace("''", "'") if token.startswith("'") else token
        want_length = False
        closed = depth == 0
    if seen and closed:
        yield from map(tuple, rows)


def tree_nodes(df: DataFrame, key: str, text: str) -> DataFrame:
    """key and the nodes of the tree in ``text`` (columns of ``NODE_SCHEMA``); texts pass in Arrow batches through the tasks that read them."""
    names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(parse_nodes(t)) for t in batch.column(1).to_pylist()]
            flat = [row for rows in found for row in rows]
            at = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int64())
            columns = [pa.array([row[k] for row in flat], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *columns], names=[key, *names])

    return df.select(key, text).mapInArrow(parse, f"{key} {dict(df.dtypes)[key]}, {NODE_SCHEMA}")


def annotation_value(annotation: Column, name: str) -> Column:
    """The value of a name in an annotation (``&rate=1,set={a,b}``); of a name that is only part of another there is none."""
    found = F.regexp_extract(annotation, rf'(?:^|[,&]){re.escape(name)}=(\{{[^}}]*\}}|"[^"]*"|[^,]*)', 1)
    return F.nullif(F.regexp_replace(found, '^["{]|["}]$', ""), F.lit(""))


def annotation_map(annotation: Column) -> Column:
    """All names of an annotation with their values (lists without braces, texts without quotes); of a name that comes twice the last."""
    found = F.regexp_extract_all(annotation, F.lit(r'[^,&={}"\[]+=(?:\{[^}]*\}|"[^"]*"|[^,]*)'), F.lit(0))
    entry = lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.regexp_replace(F.regexp_replace(x, "^[^=]*=", ""), '^["{]|["}]$', "").alias("value"))
    last = F.transform(F.array_distinct(F.transform(found, lambda x: F.substring_index(x, "=", 1))), lambda k: F.element_at(F.filter(F.transform(found, entry), lambda e: e["key"] == k), -1))
    return F.map_from_entries(last)


def state_tag(nodes: DataFrame, preferred: str | None = None) -> str | None:
    """The annotation name that holds the states: the preferred one if any node has it, else the one of most nodes whose values are no numbers (of equals the least)."""
    entries = nodes.where("annotation is not null").select(F.explode(annotation_map(F.col("annotation"))).alias("name", "value"))
    counts = entries.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.regexp_replace("value", r"[,\s]", "").try_cast("double").isNull()).alias("texts"))
    fit = counts.where((F.col("name") == preferred) | ((F.col("texts") > 0) & ~F.col("name").rlike(r"\.(set|prob|set\.prob)$")))
    best = fit.orderBy(F.desc(F.col("name").eqNullSafe(F.lit(preferred))), F.desc("n"), "name").select("name").first()
    return best[0] if best else None


def decoded(state: Column, codes: str) -> Column:
    """The name of a state's code by a list ``name=code,...``; codes that the list lacks stay as they are."""
    pairs = [p.split("=", 1) for p in codes.split(",") if "=" in p]
    table = F.create_map(*(F.lit(x.strip()) for name, code in pairs for x in (code, name))) if pairs else F.expr("cast(map() as map<string,string>)")
    return F.coalesce(F.try_element_at(table, state), state)


def small_tree_texts(nodes: DataFrame, key: str) -> DataFrame:
    """key, newick: two-level trees from rows with key, mid, tip and length, each a text of its own.

    A tree is one text by nature; use it for trees that fit one, as files of trees hold them.
    """
    tip = F.concat(F.col("tip").cast("string"), F.lit(":"), F.col("length").cast("string"))
    mids = nodes.groupBy(key, "mid").agg(F.array_sort(F.collect_list(tip)).alias("t"), F.sum("length").alias("l"))
    mid = F.concat(F.lit("("), F.array_join("t", ","), F.lit(")"), F.col("mid").cast("string"), F.lit("[&n="), F.size("t").cast("string"), F.lit("]:1.0"))
    return mids.groupBy(key).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(mid)), ","), F.lit(");")).alias("newick"))
