"""Exact column profiles per load from unpivoted column-value counts.

The table is unpivoted once and counted by load, column and value; map-side
partial counts keep a hot value (or a null that holds half the rows) from
reaching one task as rows. Everything else reads the counts: frequencies,
distinct values, ranges, broken values, forms and their drift between loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import days_in_month
from tidemark.session import checkpointed, if_small


def _is_date(text: Column) -> Column:
    year, month, day = (F.coalesce(F.get(F.split(text, "-"), F.lit(k)).try_cast("int"), F.lit(1)) for k in range(3))
    return text.rlike(r"^\d{4}(-\d{2}){0,2}$") & year.between(1900, 2025) & month.between(1, 12) & (day >= 1) & (day <= days_in_month(year, month))


def date_form(text: Column) -> Column:
    """day, month, year or range of a valid date text, else null."""
    halves = F.split(text, "/")
    single = F.when(F.length(text) == 10, "day").when(F.length(text) == 7, "month").otherwise("year")
    return F.when(_is_date(text), single).when((F.size(halves) == 2) & _is_date(halves[0]) & _is_date(F.get(halves, F.lit(1))), "range")


def lat_lon_form(text: Column) -> Column:
    """The pair of hemisphere letters of valid decimal degrees, else null."""
    part = F.split(text, " ")
    shape = text.rlike(r"^\d{1,3}(\.\d+)? [NS] \d{1,3}(\.\d+)? [EW]$")
    good = (part[0].try_cast("double") <= 90) & (F.get(part, F.lit(2)).try_cast("double") <= 180)
    return F.when(shape & good, F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3))))


def segment_form(text: Column) -> Column:
    return F.when(text.rlike(r"^([1-9]|10)$"), text)


NESTED = (T.ArrayType, T.MapType, T.StructType)
#: Columns with rules of their own: the form of a valid value, null of a broken one.
RULES = {"collection_date": date_form, "lat_lon": lat_lon_form, "segment": segment_form}


def value_form(field: Column, value: Column, numeric: list[str]) -> Column:
    """Form of a value: by the rule of its column, by magnitude, else by its shape."""
    number = value.try_cast("double")
    magnitude = F.when(number == 0, "0").otherwise(F.concat(F.when(number < 0, "-").otherwise("+"), F.floor(F.log10(F.abs(number)) * 4).cast("string")))
    shape = F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), r"[^\W\d_]+", "a")
    form = F.when(field.isin(*numeric), magnitude).otherwise(shape) if numeric else shape
    for name, rule in RULES.items():
        form = F.when(field == name, rule(value)).otherwise(form)
    return form


def value_counts(df: DataFrame, load: str, fields: list[str]) -> DataFrame:
    """load, field_name, value, n: how often each value occurs in a column of a load; lists, maps and structures by their JSON text."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, NESTED)]
    texts = df.select(F.col(load).alias("load"), *((F.to_json(c) if c in nested else F.col(c).cast("string")).alias(c) for c in fields))
    return texts.unpivot(["load"], fields, "field_name", "value").groupBy("load", "field_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _fields(df: DataFrame, load: str) -> tuple[list[str], list[str]]:
    fields = [f for f in df.schema.fields if f.name != load and isinstance(f.dataType, (T.AtomicType, *NESTED))]
    return [f.name for f in fields], [f.name for f in fields if isinstance(f.dataType, T.NumericType)]


def with_forms(counts: DataFrame, numeric: list[str]) -> DataFrame:
    """``counts`` with missing (null or empty) and form (null where the value breaks a rule)."""
    missing = F.coalesce(F.col("value") == "", F.lit(True))
    return counts.withColumn("missing", missing).withColumn("form", F.when(~missing, value_form(F.col("field_name"), F.col("value"), numeric)))


def column_profile(df: DataFrame, load: str = "load_id") -> DataFrame:
    """One row per load and column: counts, missing rate, exact distinct values, ranges, broken values.

    Null and empty values are missing. Lists, maps and structures are profiled by
    their JSON text.
    Ranges of numbers are by number, of other types by text. A null load is a
    load of its own. An empty table gives no rows.
    """
    fields, numeric = _fields(df, load)
    counts = with_forms(value_counts(df, load, fields), numeric)
    there = ~F.col("missing")
    number = F.when(there & F.col("field_name").isin(*numeric), F.col("value").try_cast("double"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return (
        counts.groupBy(F.col("load").alias(load), "field_name")
        .agg(
            F.sum("n").alias("n_rows"),
            total(F.col("missing")).alias("n_missing"),
            F.count(F.when(there, F.lit(1))).alias("n_distinct"),
            F.min(F.when(there, F.col("value"))).alias("min_text"),
            F.max(F.when(there, F.col("value"))).alias("max_text"),
            F.min(number).alias("min_number"),
            F.max(number).alias("max_number"),
            total(there & F.col("form").isNull()).alias("n_broken"),
        )
        .withColumn("missing_rate", F.col("n_missing") / F.col("n_rows"))
    )


def form_shares(counts: DataFrame) -> DataFrame:
    """load, field_name, form, share: of the missing among all rows (form null), of each form among valid values."""
    by_form = counts.where(F.col("missing") | F.col("form").isNotNull()).groupBy("load", "field_name", "missing", "form").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("load", "field_name").agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("form").isNotNull(), F.col("n"))).alias("n_valid"))
    shares = by_form.join(rows, ["load", "field_name"])
    return shares.select("load", "field_name", "form", (F.col("n") / F.when(F.col("missing"), F.col("n_rows")).otherwise(F.col("n_valid"))).alias("share"))


def load_drift(counts: DataFrame) -> DataFrame:
    """load, field_name, form, share, prev_share: shares against those of the next lower load.

    A form that is absent on one side has the share 0 there; the first load has no rows.
    """
    loads = counts.select("load").where("load is not null").distinct()
    pairs = if_small(checkpointed(loads.select("load", F.lag("load").over(Window.orderBy("load")).alias("prev")).where("prev is not null")))
    shares = form_shares(counts)
    here = shares.join(pairs, "load").select("load", "field_name", "form", "share", F.lit(0.0).alias("prev_share"))
    before = shares.withColumnRenamed("load", "prev").join(pairs, "prev").select("load", "field_name", "form", F.lit(0.0).alias("share"), F.col("share").alias("prev_share"))
    return here.unionAll(before).groupBy("load", "field_name", "form").agg(F.sum("share").alias("share"), F.sum("prev_share").alias("prev_share"))


def _edges(df: DataFrame, fields: list[str], times: list[str], bins: int) -> DataFrame:
    """field_name, edges: approximate quantiles of ordered columns, as numbers (times as seconds)."""
    at = F.array(*(F.lit(k / bins) for k in range(1, bins)))
    number = lambda f: (F.col(f).cast("timestamp") if f in times else F.col(f)).cast("double")
    quantiles = [F.struct(F.lit(f).alias("field_name"), F.percentile_approx(number(f), at, 10_000).alias("edges")) for f in fields]
    return df.agg(F.array(*quantiles).alias("q")).select(F.explode("q").alias("q")).select("q.*")


def drift_items(counts: DataFrame, ordered: list[str], limit: int) -> DataFrame:
    """load, field_name, measure, item, n: what is compared between loads.

    ``value``: whole values. ``form``: their forms, which keep changes of
    magnitude and notation together. ``word``: runs of letters or of digits in
    the whole text of columns with more than ``limit`` values, where most values
    are new in every load.
    """
    there = counts.where(~F.col("missing"))
    values = there.select("load", "field_name", F.lit("value").alias("measure"), F.col("value").alias("item"), "n")
    forms = there.where("form is not null").select("load", "field_name", F.lit("form").alias("measure"), F.col("form").alias("item"), "n")
    many = there.select("field_name", "value").distinct().groupBy("field_name").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > limit).select("field_name")
    texts = there.where(~F.col("field_name").isin(*ordered)) if ordered else there
    words = texts.join(F.broadcast(many), "field_name").select("load", "field_name", F.lit("word").alias("measure"), F.explode(F.regexp_extract_all("value", F.lit(r"\p{L}+|\p{N}+"), F.lit(0))).alias("item"), "n")
    return values.unionAll(forms).unionAll(words).groupBy("load", "field_name", "measure", "item").agg(F.sum("n").alias("n"))


def distribution_changes(df: DataFrame, load: str = "load_id", floor: float = 1e-4, skip: tuple[str, ...] = ("row_id",), limit: int = 100, bins: int = 16) -> DataFrame:
    """Population stability index of every column from each load to the next, over whole values, words and forms.

    ``psi`` sums (p - q) ln(p / q) over bins, with shares of at least ``floor``,
    and ``noise`` is what two samples of these sizes from one distribution give
    on average, (bins - 1) (1 / n + 1 / m). An item is a bin of its own in
    columns of at most ``limit`` items, or where it makes up one in ``limit`` of a
    load; other values fall into ``bins`` quantile ranges (numbers, times) or hash
    buckets of the whole text. The row is of the ``measure`` that stands out most.
    ``missing_change`` is the change of the missing rate. A psi of 0.25 above the
    noise, or such a change, counts as a shift. Columns in ``skip`` (row ids, new
    in every load) are left out.
    """
    kept = df.drop(*skip)
    fields, numeric = _fields(kept, load)
    ordered = [f.name for f in kept.schema.fields if f.name in numeric or (f.name in fields and isinstance(f.dataType, T.DateType | T.TimestampType | T.TimestampNTZType))]
    times = [f for f in ordered if f not in numeric]
    counts = checkpointed(with_forms(value_counts(kept, load, fields), numeric).where("load is not null"))
    items = checkpointed(drift_items(counts, ordered, limit))
    totals = if_small(checkpointed(items.groupBy("load", "field_name", "measure").agg(F.sum("n").alias("total"))))
    tops = items.join(totals, ["load", "field_name", "measure"]).groupBy("field_name", "measure", "item").agg(F.max(F.col("n") / F.col("total")).alias("top"))
    kinds = tops.groupBy("field_name", "measure").agg(F.count(F.lit(1)).alias("k"))
    own = checkpointed(tops.join(F.broadcast(kinds), ["field_name", "measure"]).where((F.col("k") <= limit) | (F.col("top") * limit >= 1)).select("field_name", "measure", "item", F.lit(True).alias("own")))
    binned = items.join(if_small(own), ["field_name", "measure", "item"], "left")
    bucket = F.concat(F.lit("h"), F.pmod(F.xxhash64("item"), F.lit(bins)))
    if ordered:
        number = F.col("item").try_cast("double")
        number = F.when(F.col("field_name").isin(*times), F.col("item").try_cast("timestamp").cast("double")).otherwise(number) if times else number
        binned = binned.join(F.broadcast(_edges(kept, ordered, times, bins)), "field_name", "left").withColumn("number", number)
        place = F.concat(F.lit("q"), F.size(F.filter("edges", lambda e: e < F.col("number"))))
        bucket = F.when((F.col("measure") == "value") & F.col("edges").isNotNull(), place).otherwise(bucket)
    shares = binned.groupBy("load", "field_name", "measure", F.coalesce("own", F.lit(False)).alias("own"), F.when(F.col("own"), F.col("item")).otherwise(bucket).alias("bin")).agg(F.sum("n").alias("n"))
    shares = checkpointed(shares.join(totals, ["load", "field_name", "measure"]))
    # Every load meets its next lower one; a bin that one of them lacks has the share 0 there.
    pairs = if_small(checkpointed(counts.select("load").distinct().select("load", F.lag("load").over(Window.orderBy("load")).alias("prev")).where("prev is not null")))
    before = shares.withColumnRenamed("load", "prev").join(pairs, "prev").select("load", "field_name", "measure", "own", "bin", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"), F.col("n").alias("m"), F.col("total").alias("prev_total"))
    here = shares.join(pairs, "load").select("load", "field_name", "measure", "own", "bin", "n", "total", F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("prev_total"))
    whole = Window.partitionBy("load", "field_name", "measure")
    both = here.unionAll(before).withColumns({"total": F.max("total").over(whole), "prev_total": F.max("prev_total").over(whole)})
    both = both.groupBy("load", "field_name", "measure", "own", "bin").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.max("total").alias("total"), F.max("prev_total").alias("prev_total"))
    p, q = (F.greatest(F.coalesce(F.col(c) / F.nullif(F.col(t), F.lit(0)), F.lit(0.0)), F.lit(floor)) for c, t in (("n", "total"), ("m", "prev_total")))
    noise = (F.count(F.lit(1)) - 1) * (1 / F.greatest(F.max("total"), F.lit(1)) + 1 / F.greatest(F.max("prev_total"), F.lit(1)))
    psi = both.groupBy("load", "field_name", "measure").agg(F.sum((p - q) * F.log(p / q)).alias("psi"), noise.alias("noise"))
    best = psi.groupBy("load", "field_name").agg(F.max(F.struct((F.col("psi") - F.col("noise")).alias("excess"), "measure", "psi", "noise")).alias("b"))
    rates = counts.groupBy("load", "field_name").agg((F.coalesce(F.sum(F.when(F.col("missing"), F.col("n"))), F.lit(0)) / F.sum("n")).alias("rate"))
    changes = rates.join(pairs, "load").join(rates.select(F.col("load").alias("prev"), "field_name", F.col("rate").alias("old_rate")), ["prev", "field_name"])
    out = changes.join(best, ["load", "field_name"], "left").select(
        F.col("load").alias(load), "field_name", F.coalesce("b.psi", F.lit(0.0)).alias("psi"), F.coalesce("b.noise", F.lit(0.0)).alias("noise"), "b.measure", (F.col("rate") - F.col("old_rate")).alias("missing_change"), F.coalesce("b.excess", F.lit(0.0)).alias("excess")
    )
    return out.withColumn("shifted", (F.col("excess") > 0.25) | (F.abs("missing_change") > 0.25)).drop("excess")


def quality_cases(df: DataFrame, load: str = "load_id", row_id: str = "row_id", limit: float = 0.25) -> DataFrame:
    """Broken cells and changed loads of the columns in ``RULES``: field_name, case_kind, case_id.

    ``cell`` (the row id): neither missing nor valid to the letter. ``load``: the
    share of missing values, or of one form among valid values, differs by more
    than ``limit`` from the next lower load. Broken values come from the value
    counts; rows that hold one are found by joining on the value.
    """
    fields = list(RULES)
    counts = with_forms(value_counts(df, load, fields), [])
    broken = counts.where(~F.col("missing") & F.col("form").isNull()).select("field_name", "value").distinct()
    cells = df.select(F.col(row_id).cast("long").alias("case_id"), *(F.col(c).cast("string").alias(c) for c in fields)).unpivot(["case_id"], fields, "field_name", "value")
    cells = cells.where("value <> ''").join(broken, ["field_name", "value"], "left_semi").select("field_name", F.lit("cell").alias("case_kind"), "case_id")
    moved = load_drift(counts).where(F.abs(F.col("share") - F.col("prev_share")) > limit).select("field_name", F.lit("load").alias("case_kind"), F.col("load").cast("long").alias("case_id")).distinct()
    return cells.unionAll(moved)
