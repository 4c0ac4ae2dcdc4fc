"""Schemas that drift between files, read into one table with every change listed.

Files come as text cells (``payload``) of a table, tab-separated or JSON. Every
record becomes a map from field to value with its raw type; path-type statistics
by file say which fields a file has and of what type; files of a series are
compared with the next earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed, if_small

SERIES = ["pathogen", "kind"]
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _bare(text: Column) -> Column:
    """Without outer blanks, a mark at the file start, and quotes."""
    trimmed = F.regexp_replace(text, r"^[\s\p{Z}﻿]+|[\s\p{Z}]+$", "")
    unquoted = F.regexp_replace(trimmed, '^"|"$', "")
    return F.regexp_replace(unquoted, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def latest_files(df: DataFrame) -> DataFrame:
    """Of several files of a series and date the one loaded last (then of the greatest build_id)."""
    body = F.struct("loaded_at", "build_id", "payload_format", "payload")
    latest = df.where("pathogen is not null and kind is not null and build_date is not null").groupBy(*SERIES, "build_date").agg(F.max(body).alias("f"))
    return latest.select(*SERIES, "build_date", "f.build_id", F.lower(F.trim("f.payload_format")).alias("payload_format"), "f.payload")


def file_cells(files: DataFrame) -> DataFrame:
    """One row per file, record and field: series, build_date, build_id, rec, clade, field, value, raw_type.

    raw_type is the JSON type (number, flag, list, text) or ``cell`` for
    tab-separated text; value is null where it is missing. Comment lines (#) and
    blank lines are skipped, short lines leave their last fields missing, text
    that is no JSON gives no records.
    """
    head = [*SERIES, "build_date", "build_id"]
    text = F.regexp_replace(F.coalesce("payload", F.lit("")), r"^[\s﻿]+", "")
    lines = F.filter(F.split(text, r"\r\n|\r|\n"), lambda x: ~x.rlike(r"^\s*(#|$)"))
    files = files.select(*head, "payload_format", lines.alias("lines")).where(F.size("lines") > 0)
    tsv = files.where("payload_format = 'tsv'").select(*head, F.transform(F.split(F.get("lines", F.lit(0)), "\t"), _bare).alias("names"), F.posexplode(F.expr("slice(lines, 2, greatest(size(lines) - 1, 0))")).alias("rec", "line"))
    tsv = tsv.select(*head, F.col("rec").cast("long").alias("rec"), "names", F.transform(F.split("line", "\t"), lambda c: F.nullif(_bare(c), F.lit(""))).alias("vals"))
    place = F.array_position("names", "clade").cast("int")
    tsv = tsv.select(*head, "rec", F.when(place > 0, F.get("vals", place - 1)).alias("clade"), F.explode(F.arrays_zip("names", "vals")).alias("c"))
    tsv = tsv.select(*head, "rec", "clade", F.col("c.names").alias("field"), F.col("c.vals").alias("value"), F.lit("cell").alias("raw_type")).where("field is not null")
    joined = F.array_join("lines", "\n")
    json = files.where("payload_format = 'json'").select(*head, F.when(joined.startswith("["), F.array(joined)).otherwise(F.col("lines")).alias("docs"))
    json = json.select(*head, F.posexplode("docs").alias("line", "doc"))
    parsed = F.when(F.col("doc").startswith("["), F.from_json("doc", "array<map<string,variant>>")).otherwise(F.array(F.from_json("doc", "map<string,variant>")))
    json = json.select(*head, "line", F.posexplode(parsed).alias("rec", "m")).where("m is not null")
    entries = F.transform(F.map_entries("m"), lambda e: F.struct(_bare(e["key"]).alias("field"), e["value"].alias("v")))
    json = json.select(*head, (F.shiftleft(F.col("line").cast("long"), 32) + F.col("rec")).alias("rec"), entries.alias("e"))
    json = json.withColumn("clade", F.expr("try_variant_get(get(filter(e, x -> x.field = 'clade'), 0).v, '$', 'string')")).select(*head, "rec", "clade", F.explode("e").alias("e"))
    json = json.select(*head, "rec", "clade", F.col("e.field").alias("field"), F.col("e.v").alias("v"))
    kind = F.schema_of_variant("v")
    raw = F.when(kind == "BOOLEAN", "flag").when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), "number").when(kind.startswith("ARRAY"), "list").otherwise("text")
    value = F.when(kind != "VOID", F.coalesce(F.expr("try_variant_get(v, '$', 'string')"), F.expr("to_json(v)")))
    json = json.select(*head, "rec", "clade", "field", value.alias("value"), raw.alias("raw_type"))
    return tsv.unionByName(json)


def path_types(cells: DataFrame) -> DataFrame:
    """Statistics by file and field: n_values, n_missing and field_type (null if no value is there)."""
    value, raw = F.col("value"), F.col("raw_type")
    there = value.isNotNull()
    number, flag = (raw == "number") | ((raw == "cell") & value.rlike(NUMBER)), (raw == "flag") | ((raw == "cell") & value.rlike("^(?i)(true|false)$"))
    stats = cells.groupBy(*SERIES, "build_date", "build_id", "field").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("value").alias("n_values"), F.count_if(there & number).alias("n_number"), F.count_if(there & flag).alias("n_flag"), F.count_if(there & (raw == "list")).alias("n_list")
    )
    n = F.col("n_values")
    kind = F.when(n == 0, None).when(F.col("n_number") == n, "number").when(F.col("n_flag") == n, "flag").when(F.col("n_list") == n, "list").otherwise("text")
    return stats.withColumn("field_type", kind)


def _pairs(stats: DataFrame) -> DataFrame:
    files = stats.select(*SERIES, "build_date", "build_id").distinct()
    prev = F.lag("build_date").over(Window.partitionBy(*SERIES).orderBy("build_date"))
    return files.withColumn("prev_date", prev).where("prev_date is not null")


def schema_changes(df: DataFrame, same: float = 0.8) -> DataFrame:
    """Differences between each file of ``df`` and that of the next earlier date (``cell_changes`` of its cells)."""
    return cell_changes(checkpointed(file_cells(latest_files(df))), same)


def cell_changes(cells: DataFrame, same: float = 0.8) -> DataFrame:
    """Differences between each file and that of the next earlier date: build_id, field_name, change_kind, old_name, old_type, new_type.

    ``renamed``: one field goes and another comes with equal values (missing
    equals missing) in at least ``same`` of the clades of both files; of several
    candidates the best pair counts. Else ``added``, ``removed`` (old name) or
    ``retyped``; a field without any value has no type and is not retyped. A file
    without readable records is skipped. ``cells`` is read several times.
    """
    stats = checkpointed(path_types(cells))
    pairs = checkpointed(_pairs(stats))
    now = stats.join(pairs.select(*SERIES, "build_date", "prev_date"), [*SERIES, "build_date"]).select(*SERIES, "build_date", "field", F.col("field_type").alias("t"), F.lit(1).alias("side"))
    then = stats.drop("build_id").withColumnRenamed("build_date", "prev_date").join(pairs, [*SERIES, "prev_date"]).select(*SERIES, "build_date", "field", F.col("field_type").alias("t"), F.lit(0).alias("side"))
    pick = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    fields = now.unionAll(then).groupBy(*SERIES, "build_date", "field").agg(F.max("side").alias("hi"), F.min("side").alias("lo"), pick(1, "t").alias("new_type"), pick(0, "t").alias("old_type"))
    fields = checkpointed(fields.where("lo = 1 or hi = 0 or old_type <> new_type").join(pairs, [*SERIES, "build_date"]))
    came, gone = (if_small(fields.where(side).select(*SERIES, "build_date", "prev_date", "field")) for side in ("lo = 1", "hi = 0"))
    series = [*SERIES, "build_date"]
    touched = if_small(gone.select(*series, "prev_date").distinct())
    both_dates = touched.select(*SERIES, F.explode(F.array("build_date", "prev_date")).alias("build_date")).distinct()
    clades = checkpointed(cells.where("clade is not null").select(*series, "clade").distinct().join(both_dates, series))
    shared = clades.join(touched, series)
    shared = checkpointed(shared.join(clades.withColumnRenamed("build_date", "prev_date"), [*SERIES, "prev_date", "clade"]))
    sizes = shared.groupBy(*series).agg(F.count(F.lit(1)).alias("n_clades"))
    values = cells.where("clade is not null and value is not null").select(*series, "clade", "field", "value")
    one = F.min("value")
    old_values = values.withColumnRenamed("build_date", "prev_date").join(gone, [*SERIES, "prev_date", "field"]).groupBy(*series, "clade", F.col("field").alias("old")).agg(one.alias("v0")).join(shared.select(*series, "clade"), [*series, "clade"])
    new_values = values.join(came.drop("prev_date"), [*series, "field"]).groupBy(*series, "clade", F.col("field").alias("new")).agg(one.alias("v1")).join(shared.select(*series, "clade"), [*series, "clade"])
    both = old_values.join(new_values, [*series, "clade"]).groupBy(*series, "old", "new").agg(F.count(F.lit(1)).alias("n_both"), F.count_if(F.col("v0") == F.col("v1")).alias("n_equal"))
    filled = lambda v, side: v.groupBy(*series, side).agg(F.count(F.lit(1)).alias(f"n_{side}"))
    match = both.join(sizes, series).join(filled(old_values, "old"), [*series, "old"]).join(filled(new_values, "new"), [*series, "new"])
    neither = F.col("n_clades") - F.col("n_old") - F.col("n_new") + F.col("n_both")
    match = match.withColumn("equal", (F.col("n_equal") + neither) / F.col("n_clades")).where((F.col("equal") >= same) & (F.col("n_equal") > 0))
    best = lambda side, other: F.row_number().over(Window.partitionBy(*SERIES, "build_date", side).orderBy(F.desc("equal"), F.desc("n_equal"), other))
    match = match.withColumn("r_new", best("new", "old")).withColumn("r_old", best("old", "new")).where("r_new = 1 and r_old = 1")
    renamed = match.join(pairs, [*SERIES, "build_date"]).select("build_id", "old", "new")
    changes = fields.select(
        "build_id", "field", F.when(F.col("lo") == 1, "added").when(F.col("hi") == 0, "removed").when(F.col("old_type") != F.col("new_type"), "retyped").alias("change_kind"), "old_type", "new_type"
    ).where("change_kind is not null")
    sides = renamed.select("build_id", F.explode(F.array(F.struct(F.col("new").alias("field"), F.lit("added").alias("change_kind"), F.col("old").alias("mate")), F.struct(F.col("old").alias("field"), F.lit("removed").alias("change_kind"), F.lit(None).cast("string").alias("mate")))).alias("s"))
    sides = sides.select("build_id", "s.*").withColumn("hit", F.lit(True))
    out = changes.join(sides, ["build_id", "field", "change_kind"], "left").where("hit is null or mate is not null")
    return out.select("build_id", F.col("field").alias("field_name"), F.when(F.col("hit"), "renamed").otherwise(F.col("change_kind")).alias("change_kind"), F.col("mate").alias("old_name"), "old_type", "new_type")


#: The consistent table: columns and their types.
CLADE_COLUMNS = {
    "n_tips": "bigint", "n_dated": "bigint", "diversity": "double", "span_years": "double", "earliest": "double", "latest": "double", "slope": "double", "r_squared": "double",
    "perm_p": "double", "implied_root": "double", "stem_support": "double", "min_internal_support": "double", "verdict": "string", "reference_lineages": "string",
}


def field_names(df_changes: DataFrame) -> DataFrame:
    """field, column: the canonical column that a field name stands for, followed through all renames.

    A renamed field takes the column of the field it came from; names that no
    column of the table is linked to take the least of the names they are linked
    to (those without capitals first). Names are few (bounded by the field names
    in use), so label rounds are small joins; they end when no label changes.
    """
    links = df_changes.where("change_kind = 'renamed'").select(F.col("field_name").alias("a"), F.col("old_name").alias("b"))
    links = checkpointed(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a", "b").agg(F.count(F.lit(1)).alias("w")))
    labels = links.sparkSession.createDataFrame([(c, c, 0) for c in ["clade", *CLADE_COLUMNS]], "field string, column string, hops int")
    hop, known, before = 0, labels.count(), 0
    while known > before:
        hop += 1
        step = links.join(labels, F.col("b") == F.col("field")).select(F.col("a").alias("field"), "column", F.lit(hop).alias("hops"), "w")
        labels = checkpointed(labels.withColumn("w", F.lit(1 << 40).cast("long")).unionByName(step).groupBy("field").agg(F.max_by("column", F.struct(-F.col("hops"), F.col("w"), F.col("column"))).alias("column"), F.min("hops").alias("hops")))
        before, known = known, labels.count()
    place = F.struct((F.col("field") != F.lower("field")).alias("capitals"), F.col("field").alias("name"))
    others = checkpointed(links.select(F.col("a").alias("field")).distinct().join(labels, "field", "left_anti").withColumn("label", place))
    changed = not others.isEmpty()
    while changed:
        near = links.join(others, F.col("b") == F.col("field")).groupBy(F.col("a").alias("field")).agg(F.min("label").alias("near"))
        moved = checkpointed(others.join(near, "field", "left").select("field", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")))
        others, changed = moved.drop("moved"), not moved.where("moved").isEmpty()
    return labels.select("field", "column").unionAll(others.select("field", F.col("label.name").alias("column")))


def clade_table(df: DataFrame) -> DataFrame:
    """All files as one table: series, build_date, build_id, rec, clade, the typed columns of ``CLADE_COLUMNS``, ``failed`` and ``rest``.

    One row per file and record (``rec`` numbers them in a file), also of records
    without a clade or that come twice. ``failed`` maps a column to the text that its
    type can't hold; such values are null in the column. ``rest`` maps every other
    field, by its canonical name, to value and raw_type where a value is there. If
    a file has several fields of one column, the one of that name (else the least)
    takes it, the others are in ``rest`` by their own names. Of a field that stands
    twice in a record the greater value counts.
    """
    parsed = checkpointed(file_cells(latest_files(df)))
    names = checkpointed(field_names(cell_changes(parsed)))
    file = [*SERIES, "build_date", "build_id"]
    cells = parsed.where("value is not null").join(if_small(names), "field", "left").withColumn("column", F.coalesce("column", "field"))
    cells = checkpointed(cells.groupBy(*file, "rec", "clade", "column", "field").agg(F.max(F.struct("value", "raw_type")).alias("x")))
    owners = checkpointed(cells.groupBy(*file, "column").agg(F.min(F.struct(F.col("field") != F.col("column"), "field"))["field"].alias("owner")))
    cells = cells.join(if_small(owners), [*file, "column"]).withColumn("column", F.when(F.col("field") == F.col("owner"), F.col("column")).otherwise(F.col("field")))
    other = ~F.col("column").isin("clade", *CLADE_COLUMNS)
    rows = cells.groupBy(*file, "rec", "clade").agg(
        *(F.max(F.when(F.col("column") == c, F.col("x.value"))).alias(f"_{c}") for c in CLADE_COLUMNS),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(other, F.struct(F.col("column").alias("key"), F.col("x").alias("value")))))).alias("rest"),
    )
    casts = {c: F.col(f"_{c}").try_cast(t) for c, t in CLADE_COLUMNS.items()}
    failed = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(c).alias("key"), F.when(casts[c].isNull(), F.col(f"_{c}")).alias("value")) for c in CLADE_COLUMNS)), lambda x: x["value"].isNotNull()))
    return rows.select(*file, "rec", "clade", *(v.alias(c) for c, v in casts.items()), failed.alias("failed"), "rest")
