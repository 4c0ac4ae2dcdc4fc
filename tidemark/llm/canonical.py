"""Freely entered values led to a canonical list.

Words of the texts meet words of the reference list by a partition-based
pigeonhole join: a reference word that may differ by k typing errors is cut into
k + 1 segments, at least one of which a matching word holds intact, at most k
places away. Segments are joined by equality on (substring, position), verified
with the built-in levenshtein, and values that name nothing are reported through
an anti join. Only built-in expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpointed, if_small

ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def normalised(text: Column) -> Column:
    """Lower case, plain letters, everything else a single blank; 0 in a word is read as o."""
    plain = F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), "[^a-z0-9]+", " ")
    return F.trim(F.regexp_replace(plain, "(?<=[a-z])0|0(?=[a-z])", "o"))


def reference_names(rules: DataFrame) -> DataFrame:
    """The list by what a text may name: kind, w1, w2, lineno, canonical, host_group.

    kind ``one`` (w1), ``two`` (w1 w2 in this order, for two words also reversed,
    else the last two), ``three`` (the last word, then the first two as in
    "fox, long eared") or ``short`` (w1 is the first letter of the first word, w2
    the second). Of equal names the lowest lineno holds. Patterns without a
    letter are left out.
    """
    words = F.split(normalised(F.col("pattern")), " ")
    named = rules.where(normalised(F.col("pattern")) != "").select("lineno", "canonical", "host_group", words.alias("w"), F.size(words).alias("n"))
    at = lambda k: F.element_at("w", k)
    name = lambda kind, a, b, c=F.lit(""): F.struct(F.lit(kind).alias("kind"), a.alias("w1"), b.alias("w2"), c.alias("w3"))
    none = F.lit("")
    one = F.array(name("one", at(1), none))
    glued = F.array(name("one", F.concat(at(-2), at(-1)), none), name("one", F.concat_ws("", "w"), none))
    two = F.array(name("two", at(-2), at(-1)), F.when(F.col("n") == 2, name("two", at(-1), at(1))).otherwise(name("three", at(-1), at(1), at(2))))
    binomial = F.lower("canonical") == F.concat_ws(" ", "w")
    short = F.array(name("short", F.substring(at(1), 1, 1), at(2)), name("one", F.concat(F.substring(at(1), 1, 1), at(2)), none))
    names = F.when(F.col("n") == 1, one).otherwise(F.concat(two, glued, F.when(binomial & (F.col("n") == 2), short).otherwise(F.array().cast("array<struct<kind:string,w1:string,w2:string,w3:string>>"))))
    rows = named.select("lineno", "canonical", "host_group", F.explode(names).alias("x")).select("x.*", "lineno", "canonical", "host_group")
    return rows.groupBy("kind", "w1", "w2", "w3").agg(F.min(F.struct("lineno", "canonical", "host_group")).alias("r")).select("kind", "w1", "w2", "w3", "r.*")


def edits_allowed(word: Column) -> Column:
    """k, the typing errors that a word may hold (a letter too many, missing or wrong, or two neighbours swapped): 2 from 6 letters on, 1 from 3 on."""
    return F.when(F.length(word) >= 6, 2).when(F.length(word) >= 3, 1).otherwise(0)


def _swaps(word: Column) -> Column:
    """Every text that comes of ``word`` by swapping two neighbouring letters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(word) - 1, F.lit(1)))
    piece = lambda i, n: F.substr(word, i, n)
    return F.transform(at, lambda i: F.concat(piece(F.lit(1), i - 1), piece(i + 1, F.lit(1)), piece(i, F.lit(1)), F.substr(word, i + 2)))


def _accepted(word: Column, token: Column) -> Column:
    """Distance if the token is the word or its plural, or becomes it by at most k typing errors one after the other, else null."""
    d, k = F.levenshtein(word, token), edits_allowed(word)
    near = lambda a, b: F.exists(_swaps(a), lambda v: F.levenshtein(v, b) <= k - 1)
    swapped = near(word, token) | ((k == 2) & (near(token, word) | F.arrays_overlap(_swaps(word), _swaps(token))))
    return F.when(token == F.concat(word, F.lit("s")), 0).when(d <= k, d).when((k >= 1) & (d <= 2 * k) & swapped, d)


def word_segments(words: DataFrame) -> DataFrame:
    """word, k, seg, pos: the k + 1 segments of every word at all places where a token may hold them.

    A swap across the border of two segments leaves neither intact, so segments
    also stand with the neighbouring letter at either end. Segments have two
    letters or more. Words of up to three letters are too short for that and
    stand as a whole and with each letter left out (pos -1).
    """
    k, n = edits_allowed(F.col("word")), F.length("word")
    cuts = words.where(n > 3).select("word", k.alias("k"), F.explode(F.sequence(F.lit(0), k)).alias("i"))
    bound = lambda i: F.floor(i * F.length("word") / (F.col("k") + 1)).cast("int")
    cuts = cuts.select("word", "k", bound(F.col("i")).alias("at"), bound(F.col("i") + 1).alias("end"))
    whole, before, after = "substring(word, at + 1, end - at)", "substring(word, at, 1)", "substring(word, end + 1, 1)"
    left, right = f"{before} || substring(word, at + 2, end - at - 1)", f"substring(word, at + 1, end - at - 1) || {after}"
    both = f"{before} || substring(word, at + 2, end - at - 2) || {after}"
    segs = F.expr(f"explode(array_distinct(filter(array({whole}, if(at > 0, {left}, null), if(end < length(word), {right}, null), if(at > 0 and end < length(word), {both}, null)), x -> x is not null)))")
    cuts = cuts.select("word", "k", "at", segs.alias("seg")).select("word", "k", "seg", F.expr("explode(sequence(greatest(at - k, 0), at + k))").alias("pos"))
    short = words.where((n <= 3) & (n > 0)).select("word", k.alias("k"), F.explode(one_letter_out("word")).alias("seg"), F.lit(-1).alias("pos"))
    return cuts.unionByName(short)


def one_letter_out(name: str) -> Column:
    """A short text and what is left of it without each of its letters."""
    return F.expr(f"array_distinct(filter(concat(array({name}), transform(sequence(1, length({name})), i -> substring({name}, 1, i - 1) || substring({name}, i + 1))), x -> x <> ''))")


def candidate_pairs(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """token, word pairs (repeated) that share a segment at a fitting place and may have fitting lengths."""
    refs = checkpointed(word_segments(words))
    # Which widths a token is cut into follows from its length: those of the segments of words about as long.
    widths = refs.where("pos >= 0").select(F.expr("explode(sequence(length(word) - k, length(word) + k))").alias("n"), F.length("seg").alias("w")).distinct()
    cut = tokens.select("token", F.length("token").alias("n")).join(if_small(widths), "n").where("w <= n")
    grams = cut.select("token", "w", F.expr("explode(sequence(0, n - w))").alias("pos")).selectExpr("token", "pos", "substring(token, pos + 1, w) as seg")
    short = tokens.where(F.length("token").between(1, 4)).select("token", F.lit(-1).alias("pos"), F.explode(one_letter_out("token")).alias("seg"))
    return grams.unionByName(short).join(if_small(refs), ["seg", "pos"]).where("abs(length(word) - length(token)) <= greatest(k, 1)").select("token", "word")


def pigeonhole_matches(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """token, words: for each distinct token the nearest words of the list within the allowed typing errors.

    ``tokens`` has a column token, ``words`` a column word. Every pair within k
    errors shares a segment, so the join loses none, however long the words are.
    The candidates of a token are bounded by the list. Tokens without a word are
    left out.
    """
    found = candidate_pairs(tokens, words).groupBy("token").agg(F.collect_set("word").alias("c"))
    scored = F.filter(F.transform("c", lambda w: F.struct(_accepted(w, F.col("token")).alias("d"), w.alias("word"))), lambda x: x["d"].isNotNull())
    found = found.select("token", scored.alias("c")).where(F.size("c") > 0)
    return found.select("token", F.expr("transform(filter(c, x -> x.d = array_min(transform(c, y -> y.d))), x -> x.word)").alias("words"))


def match_names(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """The entries of the list that each text names: t, named (array of canonical, host_group).

    ``texts`` has distinct normalised texts t. A name covers its words: a one-word
    name inside a two-word name doesn't count, nor does a genus (``X sp.``) beside
    a species of it. Texts that name nothing have no rows.
    """
    rows = texts.select(F.col("t").alias("_key"), F.filter(F.split("t", " "), lambda x: x != "").alias("w"))
    rows = rows.select("_key", F.posexplode("w").alias("pos", "token"), "w").select("_key", "pos", "token", F.when(F.col("pos") > 0, F.substring(F.get("w", F.col("pos") - 1), 1, 1)).alias("initial"))
    names = checkpointed(reference_names(rules))
    vocabulary = names.select(F.explode(F.array(F.when(F.col("kind") != "short", F.col("w1")), "w2", "w3")).alias("word")).where("word <> ''").distinct()
    matches = checkpointed(pigeonhole_matches(rows.select("token").distinct(), vocabulary))
    hits = rows.join(if_small(matches), "token").groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("pos", "words", "initial"))).alias("h"))
    # Every word by itself, with the letter before it, and with the one or two matched words that follow at once.
    candidates = """flatten(transform(h, (a, i) -> concat(
        transform(a.words, x -> struct(a.pos as at, a.pos as upto, 'one' as kind, x as w1, '' as w2, '' as w3)),
        if(a.initial is null, array(), transform(a.words, x -> struct(a.pos - 1 as at, a.pos as upto, 'short' as kind, a.initial as w1, x as w2, '' as w3))),
        if(get(h, i + 1).pos = a.pos + 1, flatten(transform(a.words, x -> transform(get(h, i + 1).words, y -> struct(a.pos as at, a.pos + 1 as upto, 'two' as kind, x as w1, y as w2, '' as w3)))), array()),
        if(get(h, i + 1).pos = a.pos + 1 and get(h, i + 2).pos = a.pos + 2, flatten(transform(a.words, x -> flatten(transform(get(h, i + 1).words, y -> transform(get(h, i + 2).words, z ->
            struct(a.pos as at, a.pos + 2 as upto, 'three' as kind, x as w1, y as w2, z as w3)))))), array()))))"""
    found = hits.select("_key", F.explode(F.expr(candidates)).alias("c")).select("_key", "c.*").join(if_small(names), ["kind", "w1", "w2", "w3"])
    entry = F.struct("canonical", "host_group")
    spots = found.select("_key", F.explode(F.sequence("at", "upto")).alias("pos"), (F.col("kind") != "one").alias("wide"), entry.alias("entry"))
    per_spot = spots.groupBy("_key", "pos").agg(F.max("wide").alias("any_wide"), F.collect_set(F.struct("wide", "entry")).alias("e"))
    kept = F.transform(F.filter("e", lambda x: x["wide"] == F.col("any_wide")), lambda x: x["entry"])
    named = per_spot.select("_key", F.explode(kept).alias("entry")).groupBy("_key").agg(F.collect_set("entry").alias("named"))
    without_genus = "filter(named, x -> not (x.canonical like '% sp.' and exists(named, y -> y.canonical <> x.canonical and substring_index(y.canonical, ' ', 1) = substring_index(x.canonical, ' ', 1))))"
    return named.select(F.col("_key").alias("t"), F.expr(without_genus).alias("named"))


def canonical_values(df: DataFrame, rules: DataFrame, key: str = "host_id", text: str = "host_raw") -> DataFrame:
    """One row per row of ``df``: key, canonical, host_group, ambiguous, n_named, reason.

    Exactly one named entry gives its canonical and group. Several are ambiguous
    (reason ``several``). Texts that name none are told by an anti join, with reason
    ``empty`` (null or without a letter or digit) or ``unmatched``. Every distinct
    text is read once, so keys may be null or repeated, and a text that makes up a
    third of the rows costs no more than another.
    """
    rows = df.select(F.col(key).alias("_key"), F.coalesce(normalised(F.col(text)), F.lit("")).alias("t"))
    named = checkpointed(match_names(rows.where("t <> ''").select("t").distinct(), rules))
    one = F.size("named") == 1
    pick = lambda c: F.when(one, F.get("named", F.lit(0))[c])
    hits = rows.join(if_small(named), "t").select("_key", pick("canonical").alias("canonical"), pick("host_group").alias("host_group"), (~one).alias("ambiguous"), F.size("named").alias("n_named"), F.when(~one, "several").alias("reason"))
    none = F.lit(None).cast("string")
    missed = rows.join(if_small(named.select("t")), "t", "left_anti").select("_key", none.alias("canonical"), none.alias("host_group"), F.lit(True).alias("ambiguous"), F.lit(0).alias("n_named"), F.when(F.col("t") == "", "empty").otherwise("unmatched").alias("reason"))
    return hits.unionAll(missed).withColumnRenamed("_key", key)
