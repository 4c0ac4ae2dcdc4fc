"""Mixed timestamp formats and time zones led to one unambiguous form.

Two steps. ``parse_texts`` reads each text with built-in expressions into either
a calendar span, an instant with its offset, or a wall clock time with the zone
it needs. ``normalise_timestamps`` joins wall clock times as of their local time
to the offset intervals of their zones (``zone_intervals``): one matching
interval gives the instant, two mean that the time occurred twice, none that it
never occurred.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_number, days_in_month, is_leap, month_number
from tidemark.session import checkpointed, if_small

US_PER_DAY = 86_400_000_000
#: Days from which an offset interval is no season of summer or winter time.
LONG_DAYS = 300
#: Dashes and blanks that stand for plain ones.
DASHES = "‐‑‒–—−"
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"

#: Forms of a date and the order of their parts; the forms exclude each other.
_NAME = r"[^\W\d_]+\.?"
DATE_FORMS: tuple[tuple[str, str], ...] = (
    ("ymd", r"\d{4}(-\d{1,2}-|/\d{1,2}/|\.\d{1,2}\.)\d{1,2}"),
    ("dmy", r"\d{1,2}\.\d{1,2}\.\d{4}"),
    ("dmy", rf"\d{{1,2}}-{_NAME}-\d{{2}}(\d{{2}})?|\d{{1,2}}\.? (de )?{_NAME} (de |del )?\d{{4}}"),
    ("mdy", rf"{_NAME} \d{{1,2}},? \d{{4}}"),
    ("slash", r"\d{1,2}/\d{1,2}/\d{4}"),
    ("ym", r"\d{4}-\d{1,2}"),
    ("my", rf"{_NAME}[- ](de )?\d{{4}}"),
    ("y", r"\d{4}"),
)
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?: ?([ap]\.?m\.?))?"
_ZONE = r"(?: ?(z|[+-]\d{2}(?::?\d{2})?)| ?[\[(]([a-z_]+(?:/[a-z_+-]+[0-9]*)*)[\])]| ([a-z_]+(?:/[a-z_+-]+[0-9]*)*))?"
CLOCK = rf"^(.*\d)(?:t| |, ?){_TIME}{_ZONE}$"
#: Stands between the parts of a clock time; taken out of texts that hold it.
PART = "\u0001"
WEEKDAYS = "mon tue wed thu fri sat sun"


def tidy(raw: Column) -> Column:
    """Lower-case text with plain letters, dashes and single blanks."""
    text = F.translate(F.lower(raw), DASHES + ACCENTED + PART, "-" * len(DASHES) + PLAIN)
    return F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " "))


def _date_columns(df: DataFrame, text: str, day_first: Column, max_year: Column) -> DataFrame:
    """``df`` with {text}_y, {text}_m and {text}_d: year, month and day of a date text.

    Month and day are 0 where the text has none; all are null where it is no date,
    month and day also where a slashed date leaves the order open. Every step
    makes flat columns that later steps use more than once, so none is inlined.
    """
    name = lambda c: f"{text}_{c}"
    col = lambda c: F.col(name(c))
    plain = F.regexp_replace(F.col(text), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    df = df.withColumn(name("p"), plain)
    order = F.lit(None).cast("string")
    for kind, pattern in reversed(DATE_FORMS):
        order = F.when(col("p").rlike(f"^(?:{pattern})$"), kind).otherwise(order)
    df = df.withColumns({name("o"): order, name("t"): F.split(F.regexp_replace(col("p"), r"\bdel? ", ""), r"[-/., ]+")})
    o, t = col("o"), [F.get(col("t"), F.lit(k)) for k in range(3)]
    year = F.when(o.isin("ymd", "ym", "y"), t[0]).when(o == "my", t[1]).when(o.isNotNull(), t[2])
    month = F.when(o.isin("ymd", "ym", "dmy", "slash"), t[1]).when(o.isin("mdy", "my"), t[0])
    day = F.when(o == "ymd", t[2]).when(o.isin("dmy", "slash"), t[0]).when(o == "mdy", t[1])
    df = df.withColumns({name("yt"): year, name("mt"): month, name("dt"): day})
    number = F.when(o == "y", 0).otherwise(F.coalesce(col("mt").try_cast("int"), month_number(col("mt"))))
    df = df.withColumns({name("y0"): col("yt").try_cast("int"), name("m0"): number, name("d0"): F.when(o.isin("ym", "my", "y"), 0).otherwise(col("dt").try_cast("int"))})
    y, m, d = col("y0"), col("m0"), col("d0")
    as_df, as_mf = (d >= 1) & (d <= days_in_month(y, m)), (m >= 1) & (m <= days_in_month(y, d))
    first = F.when(o != "slash", True).when(day_first.isNotNull(), day_first).when(as_df & (~as_mf | (m == d)), True).when(as_mf & ~as_df, False)
    latest = (F.floor(max_year / 100) * 100 + y).cast("int")
    full = F.when(F.length(col("yt")) == 2, F.when(latest <= max_year, latest).otherwise(latest - 100)).otherwise(y)
    df = df.withColumns({name("f"): first, name("y"): full})
    return df.withColumns({name("m"): F.when(col("f"), m).when(~col("f"), d), name("d"): F.when(col("f"), d).when(~col("f"), m)})


def _checked(text: str, min_year: Column, max_year: Column) -> Column:
    y, m, d = (F.col(f"{text}_{c}") for c in "ymd")
    good_day = ((m == 0) & (d == 0)) | ((m >= 1) & (m <= 12) & (d == 0)) | ((d >= 1) & (d <= days_in_month(y, m)))
    return F.coalesce((y >= min_year) & (y <= max_year) & good_day, F.lit(False))


def _span(text: str) -> tuple[Column, Column]:
    """First day and the day after the last, as day numbers."""
    y, m, d = (F.col(f"{text}_{c}") for c in "ymd")
    start = day_number(y, F.greatest(m, F.lit(1)), F.greatest(d, F.lit(1)))
    length = F.when(d > 0, 1).when(m > 0, days_in_month(y, m)).otherwise(365 + is_leap(y).cast("int"))
    return start, start + length


def parse_texts(df: DataFrame, key: str, raw: str, day_first: str, min_year: str, max_year: str, *keep: str) -> DataFrame:
    """Texts read with built-in expressions only.

    Columns: key, those of ``keep``, and kind with what it has: ``none`` (no
    meaning), ``span`` (precision, start_us, end_us), ``instant`` (start_us,
    end_us) or ``wall`` (local_us and, if the text names a zone or an
    abbreviation, zone_text). Null bounds of the year are taken as 1 and 9999.
    """
    lo, hi = F.coalesce(F.col(min_year), F.lit(1)), F.coalesce(F.col(max_year), F.lit(9999))
    df = df.select(key, *keep, F.col(day_first).alias("df"), lo.alias("lo"), hi.alias("hi"), tidy(F.col(raw)).alias("s"))
    # A weekday in front says nothing more than the date behind it.
    body = F.regexp_replace(F.col("s"), rf"^(?:{WEEKDAYS.replace(' ', '|')})[a-z]*,? (?=\d)", "")
    df = df.withColumn("s", F.regexp_replace(body, r"^(\d{8})t(\d{2})(\d{2})(\d{2})(?!\d)", "$1t$2:$3:$4"))
    s = F.col("s")
    # One pass of the pattern takes a clock time apart; other texts stay in one piece.
    df = df.withColumns({"parts": F.split(F.regexp_replace(s, CLOCK, PART.join(f"${k}" for k in range(1, 10))), PART), "halves": F.split(s, r" ?/ ?")})
    df = df.withColumn("clock", F.coalesce(F.size("parts") == 9, F.lit(False)))
    clock = F.col("clock")
    g = lambda k: F.when(clock, F.get("parts", F.lit(k - 1)))
    is_range = F.coalesce((F.size("halves") == 2) & ~clock, F.lit(False))
    df = df.withColumns(
        {"is_range": is_range, "a": F.when(clock, F.regexp_replace(g(1), r"[ ,]+$", "")).when(is_range, F.get("halves", F.lit(0))).otherwise(s), "b": F.when(is_range, F.get("halves", F.lit(1)))}
        | {f"c{k}": g(k) for k in range(2, 8)}
        | {"zone": F.nullif(F.concat(g(8), g(9)), F.lit(""))}
    )
    for text in ("a", "b"):
        df = _date_columns(df, text, F.col("df"), F.col("hi"))
    hour, minute = F.col("c2").try_cast("int"), F.col("c3").try_cast("int")
    second = F.coalesce(F.col("c4").try_cast("int"), F.lit(0))
    micro = F.coalesce(F.rpad(F.substring("c5", 1, 6), 6, "0").try_cast("int"), F.lit(0))
    half = F.substring("c6", 1, 1)
    hour24 = F.when(half == "", hour).when((hour >= 1) & (hour <= 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    digits = F.regexp_replace("c7", "[^0-9]", "")
    (a0, a1), (b0, b1) = _span("a"), _span("b")
    df = df.withColumns(
        {"ok_a": _checked("a", F.col("lo"), F.col("hi")), "ok_b": _checked("b", F.col("lo"), F.col("hi")), "a0": a0, "a1": a1, "b0": b0, "b1": b1}
        | {"hour": hour24, "minute": minute, "second": second, "micro": micro, "oh": F.substring(digits, 1, 2).try_cast("int"), "om": F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))}
        | {"epoch": F.when(s.rlike(r"^\d{10}$"), s.try_cast("long") * 1_000_000).when(s.rlike(r"^\d{13}$"), s.try_cast("long") * 1_000)}
    )
    off = F.col("c7")
    seconds = (F.col("oh") * 60 + F.col("om")) * 60 * F.when(off.startswith("-"), -1).otherwise(1)
    offset = F.when((off == "z") | ((off == "") & (F.col("zone") == "utc")), 0).when((F.col("oh") <= 18) & (F.col("om") <= 59), seconds)
    million = F.lit(1_000_000).cast("long")
    df = df.withColumns(
        {
            "good_time": F.coalesce((F.col("hour") <= 23) & (F.col("minute") <= 59) & (F.col("second") <= 59) & (F.col("a_d") > 0), F.lit(False)),
            "offset": offset,
            "local": F.col("a0") * US_PER_DAY + ((F.col("hour") * 60 + F.col("minute")) * 60 + F.col("second")) * million + F.col("micro"),
            "epoch_year": F.year(F.timestamp_micros("epoch")),
        }
    )
    state = (
        F.when(F.col("epoch").isNotNull(), F.when((F.col("epoch_year") >= F.col("lo")) & (F.col("epoch_year") <= F.col("hi")), "epoch").otherwise("none"))
        .when(clock, F.when(~F.col("ok_a") | ~F.col("good_time"), "none").when(F.col("offset").isNotNull(), "offset").when(off != "", "none").otherwise("wall"))
        .when(F.col("is_range"), F.when(F.col("ok_a") & F.col("ok_b"), "range").otherwise("none"))
        .when(F.col("ok_a"), "span")
        .otherwise("none")
    )
    df = df.withColumn("state", state)
    state, day = F.col("state"), F.lit(US_PER_DAY)
    instant = F.when(state == "epoch", F.col("epoch")).when(state == "offset", F.col("local") - F.col("offset") * million)
    return df.select(
        key,
        *keep,
        F.when(state.isin("epoch", "offset"), "instant").when(state == "range", "span").otherwise(state).alias("kind"),
        F.when(state.isin("epoch", "offset", "wall"), "time").when(state == "range", "range").when(state == "span", F.when(F.col("a_d") > 0, "day").when(F.col("a_m") > 0, "month").otherwise("year")).alias("precision"),
        F.when(state == "span", F.col("a0") * day).when(state == "range", F.least("a0", "b0") * day).otherwise(instant).alias("start_us"),
        F.when(state == "span", F.col("a1") * day).when(state == "range", F.greatest("a1", "b1") * day).otherwise(instant).alias("end_us"),
        F.when(state == "wall", F.col("local")).alias("local_us"),
        F.when(state == "wall", F.col("zone")).alias("zone_text"),
    )


def zone_intervals(used: DataFrame) -> DataFrame:
    """Offset intervals of the zones in ``used`` (zone in lower case, year) around the local years used.

    One row per interval: zone, local_from_us, next_from_us (where the next one
    begins on the local clock), local_to_us (where it ends), offset_s, prev_to_us
    and prev_offset_s of the interval before it, and std_offset_s and dst_offset_s,
    what an abbreviation for winter or summer time stands for in it: an interval
    shorter than a season of ``LONG_DAYS`` days pairs with such neighbours, a
    longer one stands for itself. Names that are no IANA zone are left out. Offsets
    come from the engine's own zone rules; days at whose two midnights the offset
    differs are searched by the minute. Rows are bounded by the zones (about 600)
    and the years used.
    """
    names = [(n, n.lower()) for n in sorted(zoneinfo.available_timezones()) if "/" in n or n in ("UTC", "GMT")]
    known = used.sparkSession.createDataFrame(names, "name string, zone string")
    around = F.explode(F.array(*(F.col("year") + k for k in (-1, 0, 1))))
    keys = used.where("zone is not null and year between 2 and 9997").select("zone", "year").distinct().select("zone", around.alias("year")).distinct().join(if_small(known), "zone")
    offset = "(unix_micros(from_utc_timestamp(timestamp_seconds({s}), name)) div 1000000 - {s})"
    first = day_number(F.col("year"), F.lit(1), F.lit(1))
    days = keys.withColumn("first", first.cast("long") * 86400).selectExpr("*", "explode(sequence(first, first + 366 * 86400L, 86400L)) as s")
    days = days.selectExpr("zone", "year", "name", "first", "s", f"{offset.format(s='s')} as here", f"{offset.format(s='(s + 86400)')} as after")
    steps = days.where("here <> after").selectExpr("zone", "name", "explode(sequence(s + 60, s + 86400, 60L)) as s")
    steps = steps.selectExpr("zone", "s", f"{offset.format(s='s')} as here", f"{offset.format(s='(s - 60)')} as before").where("here <> before").select("zone", "s", "here")
    # Each year begins anew, as the one before may not be used; boundaries without a change fall away.
    starts = steps.unionAll(days.where("s = first").select("zone", "s", "here")).distinct()
    order = Window.partitionBy("zone").orderBy("s")
    spans = starts.withColumn("last", F.lag("here").over(order)).where("last is null or last <> here")
    spans = spans.select("zone", "s", "here", F.coalesce(F.lead("s").over(order), F.lit(1 << 38)).alias("e"))
    brief = F.when(F.col("e") - F.col("s") < LONG_DAYS * 86400, F.col("here"))
    spans = spans.withColumn("brief", brief)
    beside = [F.when(F.col("brief").isNotNull(), move("brief").over(order)) for move in (F.lag, F.lead)]
    clock = lambda t, o: (t + o) * F.lit(1_000_000).cast("long")
    s, e, here = F.col("s"), F.col("e"), F.col("here")
    return spans.select(
        "zone",
        F.when(F.lag("s").over(order).isNull(), F.lit(-(1 << 61))).otherwise(clock(s, here)).alias("local_from_us"),
        F.coalesce(clock(e, F.lead("here").over(order)), F.lit(1 << 61)).alias("next_from_us"),
        clock(e, here).alias("local_to_us"),
        here.alias("offset_s"),
        clock(s, F.lag("here").over(order)).alias("prev_to_us"),
        F.lag("here").over(order).alias("prev_offset_s"),
        F.least(here, *beside).alias("std_offset_s"),
        F.greatest(here, *beside).alias("dst_offset_s"),
    )


def intervals_by_year(intervals: DataFrame, used: DataFrame) -> DataFrame:
    """``intervals`` once for every used local year that they, or the time up to the next one, reach into: adds year."""
    years = used.where("zone is not null and year between 2 and 9997").select("zone", "year").distinct()
    first = day_number(F.col("year"), F.lit(1), F.lit(1)).cast("long") * US_PER_DAY
    after = day_number(F.col("year") + 1, F.lit(1), F.lit(1)).cast("long") * US_PER_DAY
    met = years.withColumns({"_first": first, "_after": after}).join(intervals, "zone")
    return met.where("local_from_us < _after and next_from_us > _first").drop("_first", "_after")


def normalise_timestamps(df: DataFrame, sites: DataFrame, key: str = "date_id", raw: str = "raw", site: str = "site_id") -> DataFrame:
    """One row per row of ``df``: key, outcome, precision, start_us, end_us.

    outcome is ``ok``, ``ambiguous`` (the wall clock time occurred twice),
    ``nonexistent`` (it never occurred), ``no_zone`` (no zone is known, or the
    abbreviation is not one of the site) or ``unreadable``; the other columns are
    null unless it is ``ok``. Spans end at the midnight after their last day.
    Null and blank texts are ``unreadable``; repeated rows give repeated results;
    a site that is null or not listed leaves zone and order of day and month
    open; of a site listed several times the least line (by its columns) counts.
    An empty table gives none.
    """
    listed = sites.select(F.col("site_id").alias("_site"), F.struct("day_first", *(F.lower(c).alias(f"_{c}") for c in ("tz_name", "std_abbr", "dst_abbr"))).alias("s")).where("_site is not null")
    known = checkpointed(listed.groupBy("_site").agg(F.min("s").alias("s")).select("_site", "s.*"))
    rows = df.select(F.col(key).alias("_key"), F.col(raw).alias("_raw"), F.col(site).alias("_in_site"), "min_year", "max_year")
    rows = rows.join(if_small(known), F.col("_in_site") == F.col("_site"), "left")
    rows = parse_texts(rows, "_key", "_raw", "day_first", "min_year", "max_year", "_tz_name", "_std_abbr", "_dst_abbr")
    text, wall = F.col("zone_text"), F.col("kind") == "wall"
    abbreviation = F.when(text == F.col("_std_abbr"), "std").when(text == F.col("_dst_abbr"), "dst")
    rows = rows.withColumns({"abbr": F.when(wall, abbreviation), "year": F.when(wall, F.year(F.timestamp_micros("local_us")))})
    rows = rows.withColumn("zone", F.when(wall, F.when(text.isNull() | F.col("abbr").isNotNull(), F.col("_tz_name")).otherwise(text)))
    rows = checkpointed(rows.drop("_tz_name", "_std_abbr", "_dst_abbr", "zone_text"))
    used = checkpointed(rows.select("zone", "year").where("zone is not null and year is not null").distinct())
    intervals = checkpointed(intervals_by_year(zone_intervals(used), used).withColumnsRenamed({"zone": "_zone", "year": "_year"}))
    # As of its local time a row meets one interval, the last that has begun; the one before it may not have ended yet.
    as_of = (F.col("zone") == F.col("_zone")) & (F.col("year") == F.col("_year")) & (F.col("local_us") >= F.col("local_from_us")) & (F.col("local_us") < F.col("next_from_us"))
    joined = rows.join(if_small(intervals), as_of, "left")
    now, before = F.col("local_us") < F.col("local_to_us"), F.coalesce(F.col("local_us") < F.col("prev_to_us"), F.lit(False))
    joined = joined.withColumn("n_hits", now.cast("int") + before.cast("int")).withColumn(
        "offset_used", F.when(F.col("abbr") == "std", F.col("std_offset_s")).when(F.col("abbr") == "dst", F.col("dst_offset_s")).when(F.col("n_hits") == 1, F.when(now, F.col("offset_s")).otherwise(F.col("prev_offset_s")))
    )
    outcome = (
        F.when(F.col("kind") == "none", "unreadable")
        .when(F.col("kind") != "wall", "ok")
        .when(F.col("_zone").isNull(), "no_zone")
        .when(F.col("offset_used").isNotNull(), "ok")
        .when(F.col("n_hits") == 0, "nonexistent")
        .otherwise("ambiguous")
    )
    instant = F.col("local_us") - F.col("offset_used") * F.lit(1_000_000).cast("long")
    return joined.select(
        F.col("_key").alias(key),
        outcome.alias("outcome"),
        F.when(outcome == "ok", F.col("precision")).alias("precision"),
        F.when(outcome == "ok", F.coalesce("start_us", instant)).alias("start_us"),
        F.when(outcome == "ok", F.coalesce("end_us", instant)).alias("end_us"),
    )
