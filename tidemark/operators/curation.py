"""Record curation: host rules, date texts, exclusion reasons, routing and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_number, days_in_month, is_leap, month_number
from tidemark.session import if_small

#: Texts that say that a date is not known. Fixed values.
UNKNOWN_DATES = ("unknown", "not collected", "missing", "n/a", "na", "none", "null")


def tidy_host(text: Column) -> Column:
    """Lower-case words of a host text with single blanks; anything but letters, digits and underscores parts words."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def rule_hits(df: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """key, lineno: rules whose pattern stands in a text as whole words, also in the plural.

    Word groups of the text, as long as the patterns are, meet the patterns by
    equality; no text is compared with every rule.
    """
    pattern = tidy_host(F.col("pattern"))
    named = rules.select("lineno", pattern.alias("p"), F.size(F.split(pattern, " ")).alias("n")).where("p <> ''")
    longest = named.agg(F.max("n")).first()[0] or 1
    words = df.select(F.col(key).alias("_key"), F.split(tidy_host(F.col(text)), " ").alias("w"))
    spots = words.select("_key", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
    groups = spots.select("_key", "w", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.size("w") - F.col("i") + 1))).alias("n")).select("_key", F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("g"))
    forms = groups.select("_key", F.explode(F.array_distinct(F.array("g", F.regexp_replace("g", "s$", ""), F.regexp_replace("g", "es$", "")))).alias("p"))
    return forms.join(named.select("p", "lineno"), "p").select(F.col("_key").alias(key), "lineno").distinct()


def first_rule(df: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """key, canonical, host_group, ambiguous, lineno, reason: the first rule in list order that a text matches.

    Without one the text is ambiguous, with reason ``empty_host_field`` or
    ``no_pattern_matched``.
    """
    won = rule_hits(df, rules, key, text).groupBy(key).agg(F.min("lineno").alias("lineno"))
    rows = df.select(key, tidy_host(F.col(text)).alias("_t")).join(won, key, "left").join(if_small(rules.select("lineno", "canonical", "host_group")), "lineno", "left")
    reason = F.when(F.col("lineno").isNotNull(), None).when(F.col("_t") == "", "empty_host_field").otherwise("no_pattern_matched")
    return rows.select(key, "canonical", "host_group", F.col("lineno").isNull().alias("ambiguous"), "lineno", reason.alias("reason"))


def rule_usage(df: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """lineno, canonical, n_matched, n_won, n_shadowed: how often each rule matches, and an earlier one takes the text."""
    hits = rule_hits(df, rules, key, text)
    first = F.min("lineno").over(Window.partitionBy(key))
    counts = hits.withColumn("first", first).groupBy("lineno").agg(F.count(F.lit(1)).alias("n_matched"), F.count_if(F.col("lineno") == F.col("first")).alias("n_won"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rules.select("lineno", "canonical").join(counts, "lineno", "left").select("lineno", "canonical", zero("n_matched"), zero("n_won"), (F.coalesce("n_matched", F.lit(0)) - F.coalesce("n_won", F.lit(0))).alias("n_shadowed"))


def first_pattern(text: Column, patterns: list[str]) -> Column:
    """The first pattern of the list that a text contains, whatever the case."""
    low = F.lower(text)
    return F.coalesce(*(F.when(low.contains(p.lower()), F.lit(p)) for p in patterns))


def _dated(df: DataFrame, text: str, min_year: int, max_year: int) -> DataFrame:
    """``df`` with {text}_f (form), {text}_fail (why it is no date), {text}_c and {text}_h (centre and half width in years)."""
    col = lambda c: F.col(f"{text}_{c}")
    name = lambda c: f"{text}_{c}"
    t = F.col(text)
    forms = {"ymd": r"^\d{4}-\d{1,2}-\d{1,2}$", "ym": r"^\d{4}-\d{1,2}$", "dmy": r"^\d{1,2}-[a-z]{3,}-\d{4}$", "my": r"^[a-z]{3,}-\d{4}$", "y": r"^\d{4}$"}
    df = df.withColumns({name("o"): F.coalesce(*(F.when(t.rlike(p), o) for o, p in forms.items())), name("p"): F.split(t, "-")})
    o, part = col("o"), lambda k: F.get(col("p"), F.lit(k))
    number = lambda k: part(k).try_cast("int")
    df = df.withColumns(
        {
            name("y"): F.when(o.isin("ymd", "ym", "y"), number(0)).when(o == "my", number(1)).when(o == "dmy", number(2)),
            name("m"): F.when(o.isin("ymd", "ym"), number(1)).when(o == "dmy", month_number(part(1))).when(o == "my", month_number(part(0))).when(o == "y", 1),
            name("d"): F.when(o == "ymd", number(2)).when(o == "dmy", number(0)).when(o.isNotNull(), 1),
            name("f"): F.when(o.isin("ymd", "dmy"), "day").when(o.isin("ym", "my"), "month").when(o == "y", "year"),
        }
    )
    y, m, d = col("y"), col("m"), col("d")
    df = df.withColumn(name("n"), days_in_month(y, m))
    n = col("n")
    fail = F.when(o.isNull(), "unrecognised_format").when((y < min_year) | (y > max_year), "year_out_of_range").when(m.isNull() | (m < 1) | (m > 12), "invalid_month").when((d < 1) | (d > n), "invalid_day")
    at = F.when(col("f") == "month", F.floor(n / 2) + 1).otherwise(d)
    df = df.withColumns({name("fail"): fail, name("at"): day_number(y, m, at) - day_number(y, F.lit(1), F.lit(1))})
    centre = F.when(col("f") == "year", y + 0.5).otherwise(y + col("at") / (F.lit(365) + is_leap(y).cast("int")))
    half = F.when(col("f") == "year", 0.5).when(col("f") == "month", n / 2 / 365.25).otherwise(0.5 / 365.25)
    return df.withColumns({name("c"): centre, name("h"): half})


def collection_dates(df: DataFrame, key: str, raw: str, min_year: int = 1900, max_year: int = 2026) -> DataFrame:
    """key, precision, decimal_year, uncertainty, reason of date texts; never raises.

    Ladder: empty, explicitly unknown, ``a/b`` (midpoint and half span of years,
    months or days), Y-M-D, Y-M, D-Mon-Y, Mon-Y, Y, else unrecognised. A month
    stands at its middle, a year at its half. Null counts as empty.
    """
    rows = df.select(key, F.lower(F.trim(F.coalesce(raw, F.lit("")))).alias("t")).withColumn("sides", F.split("t", "/"))
    rows = rows.withColumns({"two": F.size("sides") == 2, "a": F.trim(F.get("sides", F.lit(0))), "b": F.trim(F.get("sides", F.lit(1)))})
    for text in "tab":
        rows = _dated(rows, text, min_year, max_year)
    empty, unknown = F.col("t") == "", F.col("t").isin(*UNKNOWN_DATES)
    state = F.when(empty, "empty").when(unknown, "unknown").when(F.col("two"), F.when(F.coalesce("a_fail", "b_fail").isNull(), "range").otherwise("bad_range")).when(F.col("t_fail").isNull(), "one").otherwise("bad")
    lo, hi = F.least(F.col("a_c") - F.col("a_h"), F.col("b_c") - F.col("b_h")), F.greatest(F.col("a_c") + F.col("a_h"), F.col("b_c") + F.col("b_h"))
    rows = rows.withColumns({"state": state, "lo": lo, "hi": hi})
    of = lambda s: F.col("state") == s
    return rows.select(
        key,
        F.when(of("range"), "range").when(of("one"), F.col("t_f")).otherwise("none").alias("precision"),
        F.round(F.when(of("range"), (F.col("lo") + F.col("hi")) / 2).when(of("one"), F.col("t_c")), 6).alias("decimal_year"),
        F.round(F.when(of("range"), (F.col("hi") - F.col("lo")) / 2).when(of("one"), F.col("t_h")), 6).alias("uncertainty"),
        F.when(of("empty"), "empty").when(of("unknown"), "explicitly_unknown").when(of("bad_range"), F.coalesce("a_fail", "b_fail")).when(of("bad"), F.col("t_fail")).otherwise("").alias("reason"),
    )


def exclusion_reason(min_length: int, expected_length: int, cap: float = 1.15) -> Column:
    """The first reason that holds: vaccine, no segment, too short, too long, no date, host unknown; null if kept."""
    return (
        F.when(F.col("is_vaccine"), "vaccine_strain")
        .when(F.coalesce(F.trim("segment"), F.lit("")) == "", "no_locus")
        .when(F.col("seq_length") < min_length, "too_short")
        .when(F.col("seq_length") > cap * expected_length, "too_long")
        .when(F.col("decimal_year").isNull(), "no_usable_date")
        .when(F.coalesce(F.col("host_group"), F.lit("unknown")) == "unknown", "host_unknown")
    )


def routed(records: DataFrame, min_length: int = 400, expected_length: int = 1824) -> DataFrame:
    """``records`` with exclude_reason, review_reason and flagged.

    Review: an ambiguous host, or a date text that is there but unreadable and
    not stated as unknown (the host reason goes first). Flagged: longer than
    expected by more than 2 %, or not a multiple of three; never with review.
    """
    text = F.coalesce(F.lower(F.trim("collection_date")), F.lit(""))
    review = F.when(F.col("host_ambiguous"), "host_ambiguous").when(F.col("decimal_year").isNull() & (text != "") & ~text.isin(*UNKNOWN_DATES), "date_unreadable")
    odd = (F.col("seq_length") > 1.02 * expected_length) | (F.col("seq_length") % 3 != 0)
    return records.withColumns({"exclude_reason": exclusion_reason(min_length, expected_length), "review_reason": review, "flagged": F.coalesce(odd, F.lit(False)) & review.isNull()})


def retention(records: DataFrame, by: str = "load_id") -> DataFrame:
    """by, n_rows, n_kept, kept_share, main_reason, verdict of each load.

    ``error`` if nothing is kept, ``warn`` under half or under 20 rows, else ``ok``.
    """
    rows = routed(records).groupBy(by, "exclude_reason").agg(F.count(F.lit(1)).alias("n"))
    out = rows.groupBy(by).agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("exclude_reason").isNull(), F.col("n"))), F.lit(0)).alias("n_kept"), F.max_by("exclude_reason", F.when(F.col("exclude_reason").isNotNull(), F.struct("n", "exclude_reason"))).alias("main_reason"))
    share = F.col("n_kept") / F.col("n_rows")
    return out.withColumn("kept_share", F.round(share, 6)).withColumn("verdict", F.when(F.col("n_kept") == 0, "error").when((share < 0.5) | (F.col("n_kept") < 20), "warn").otherwise("ok"))


def record_label(multi_locus: bool = False) -> Column:
    """KEY|group|year of a record, the year with three digits; null without a date.

    The key is the accession, for several loci the isolate, else the strain;
    bars and blanks in it become an underscore.
    """
    name = F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in ("isolate", "strain")), F.col("accession")) if multi_locus else F.col("accession")
    year = F.round("decimal_year", 3).cast("decimal(10,3)").cast("string")
    return F.when(F.col("decimal_year").isNotNull(), F.concat(F.regexp_replace(name, r"[|\s]+", "_"), F.lit("|"), F.coalesce("host_group", F.lit("unknown")), F.lit("|"), year))


def label_consistency(records: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """By host_group: labels, and how many disagree with their record in group or year once read back."""
    rows = records.withColumn("label", record_label()).where("label is not null")
    part = F.split("label", r"\|")
    year = F.element_at(part, -1).try_cast("double")
    bad_host = F.element_at(part, -2) != F.coalesce("host_group", F.lit("unknown"))
    return rows.groupBy(F.coalesce("host_group", F.lit("unknown")).alias("host_group")).agg(
        F.count(F.lit(1)).alias("n_labels"), F.count_if(bad_host).alias("n_host_mismatch"), F.count_if(F.abs(year - F.col("decimal_year")) > tolerance).alias("n_year_mismatch"), F.count_if(year.isNull()).alias("n_unparsed")
    )


def isolate_linkage(records: DataFrame) -> DataFrame:
    """key, n_records, n_segments of isolates (else strains) with more than one record."""
    key = F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in ("isolate", "strain")))
    return records.select(key.alias("key"), "segment").where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("segment").alias("n_segments")).where("n_records > 1")


def group_counts(records: DataFrame) -> DataFrame:
    """By host_group and date precision: records, countries, first and last year."""
    return records.groupBy("host_group", "date_precision").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("country").alias("n_countries"), F.min("decimal_year").alias("first_year"), F.max("decimal_year").alias("last_year"))


def best_of_identical(df: DataFrame, content: str, key: str, better: list[Column]) -> DataFrame:
    """key, n_copies: of rows with equal content the best one (by ``better``, then the lowest key). Null contents are equal."""
    rank = F.struct(*better, (-F.col(key)).alias("_k"))
    return df.groupBy(F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("_h"), F.col(content).isNull().alias("_null")).agg(F.max_by(key, rank).alias(key), F.count(F.lit(1)).alias("n_copies")).select(key, "n_copies")


def rebuild_decisions(snapshots: DataFrame, few: int = 5, many: int = 500) -> DataFrame:
    """By snapshot: n, previous, delta and the decision to rebuild.

    First build: yes; fewer records: no; nothing new: no; under ``few``: no;
    over ``many``: yes with a warning; else yes.
    """
    key = F.upper(F.split(F.trim("accession"), r"\.")[0])
    sizes = snapshots.where("accession is not null").select("pathogen", "build_date", key.alias("k")).distinct().groupBy("pathogen", "build_date").agg(F.count(F.lit(1)).alias("n"))
    rows = sizes.withColumn("previous", F.lag("n").over(Window.partitionBy("pathogen").orderBy("build_date"))).withColumn("delta", F.col("n") - F.col("previous"))
    d = F.col("delta")
    return rows.withColumn("decision", F.when(d.isNull(), "first").when(d < 0, "shrunk").when(d == 0, "unchanged").when(d < few, "too_few").when(d > many, "rebuild_warn").otherwise("rebuild"))
