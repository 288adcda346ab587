"""Secret scans: patterns, and a battery of randomness tests on opaque tokens.

Pattern spans (assign, access, hex) come from regular expressions.  The method
adds spans of kind ``random``: runs of 20 or more token characters that look as
if drawn at random from the alphabet of their encoding.

For each run the alphabet is inferred (decimal, hex, one case of letters, base32,
base36, base58, letters and digits, base64 with either pair of signs; padding is
cut off) and three tests are made: chi-squared uniformity of the alphabet, a runs
test on the two halves of the alphabet, and lag-one serial correlation of
alphabet positions.
Runs and serial correlation both read the order of the characters, so these two
are joined by Bonferroni's rule, which holds for dependent tests; what they find is
joined with the chi-squared test, which reads counts alone, by Fisher's method.  A
run the battery calls non-random at ``ALPHA`` is never reported.

Short runs of ordinary text also pass such tests, so what passes is held to a
false-discovery rate.  For that the battery's statistics are read once more, under
the null of natural text: there the squared counts of the chi-squared test are
larger, since letters of either case coincide more often, and there are fewer runs,
namely words: one begins where the class of characters changes, but not after the
capital that opens a word nor after the sign that parts two, so that names in camel
case are words like others; the evidence against it grows with the length.
Benjamini-Hochberg
runs over all candidates of the corpus within strata of alphabet and length;
p-values are counted in ``BINS`` bins of a logarithmic scale, and a bin counts with
its upper edge, which errs on the safe side.  The thresholds are a few hundred
numbers, joined in as one scalar.  Everything is a DataFrame function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kontora.llm.common import PRIVATE, let, prefix_sums

#: Fixed patterns of the pattern spans.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Whole runs of one class of characters, so a least length can be part of the pattern.
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
#: Runs that the battery looks at.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALL = "+-/" + _DIGITS + "=" + _UPPER + "_" + _LOWER
#: Alphabets, smallest first: the first whose pattern fits a whole run is the one
#: it is held to.  A random run without some signs is uniform over the others, so
#: a smaller alphabet that fits by chance is right too.  The last takes the rest,
#: which no encoding writes: both pairs of signs, or = before the end.
ALPHABETS = (
    ("^[0-9]+$", _DIGITS),
    ("^(?:[0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    ("^(?:[a-z]+|[A-Z]+)$", _LOWER),
    ("^(?:[a-z2-7]+|[A-Z2-7]+)$", "234567" + _LOWER),
    ("^(?:[0-9a-v]+|[0-9A-V]+)$", _DIGITS + "abcdefghijklmnopqrstuv"),
    ("^(?:[0-9a-hjkmnp-tv-z]+|[0-9A-HJKMNP-TV-Z]+)$", _DIGITS + "abcdefghjkmnpqrstvwxyz"),
    ("^(?:[0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOWER),
    ("^[A-Za-z]{1,63}$", _ALL),  # over letters alone, names in camel case would look uniform
    ("^[A-Za-z]+$", _UPPER + _LOWER),
    ("^[1-9A-HJ-NP-Za-km-z]+$", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"),
    ("^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("^[0-9A-Za-z+/]+$", "+/" + _DIGITS + _UPPER + _LOWER),
    ("^[0-9A-Za-z_-]+$", "-" + _DIGITS + _UPPER + "_" + _LOWER),
    ("", _ALL),
)
#: Padding at the end of base32 and base64.
PADDING = "(?<=[^=])={1,6}$"
KINDS = ("assign", "access", "hex", "random")
#: Level of the battery, rate of false discoveries, bins a decade of p.
ALPHA, RATE, DECADE, BINS = 0.001, 0.01, 8, 160
#: Natural text: chance that two letters agree, and that a word begins at a character:
#: English words have 4.7 letters on average, and one more character parts them.
TEXT_AGREE, TEXT_SWITCH = 0.066, 1 / 5.7


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<s, e, k>> of the leftmost matches; t is the match."""
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("t"),
        F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x).cast("bigint")).alias("g"),
    )

    def starts(x: Column) -> Column:
        """Gaps before each match and the sizes of the matches before it, added up."""
        steps = F.transform(x["t"], lambda _, i: F.get(x["g"], i) + F.when(i > 0, F.char_length(F.get(x["t"], i - 1))).otherwise(0))
        return let(prefix_sums(F.concat(steps, F.array(F.lit(0).cast("bigint")))), lambda at: F.transform(x["t"], lambda t, i: F.struct(t.alias("t"), F.get(at, i + 1).alias("s"))))

    def span(x: Column) -> Column:
        return F.struct(x["s"].alias("s"), (x["s"] + F.char_length(x["t"])).alias("e"), F.lit(kind).alias("k"), x["t"].alias("t"))

    none = F.array().cast("array<struct<s:bigint,e:bigint,k:int,t:string>>")
    return F.when(text.rlike(pattern), F.transform(let(parts, starts), span)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Pattern spans of a text, unsorted."""
    assign = F.filter(_spans(text, ASSIGN, 0), lambda x: F.char_length(F.regexp_extract(x["t"], ASSIGN, 1)) >= 6)
    access = _spans(text, ACCESS, 1)
    return F.concat(assign, access, _spans(text, HEX, 2))


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of a normal variable (Abramowitz and Stegun 26.2.17)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.greatest(F.lit(1e-30), F.when(z >= 0, upper).otherwise(1 - upper))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def battery(run: Column) -> Column:
    """struct(enc, n, p_random, p_text) of one run of token characters."""
    return let(F.regexp_replace(run, PADDING, ""), lambda token: let(_alphabet(token), _tested))


def _alphabet(token: Column) -> Column:
    """struct(own, t, enc, order): a token in one case and as it is, the number of its alphabet, and the signs."""
    enc = F.coalesce(*(F.when(token.rlike(p), i) for i, (p, _) in enumerate(ALPHABETS)))
    one_case = [i for i, (_, a) in enumerate(ALPHABETS) if "a" in a and "A" not in a]
    signs = F.array(*(F.lit(a) for _, a in ALPHABETS))
    # One case reads as lower-case.
    return let(enc, lambda i: F.struct(F.when(i.isin(one_case), F.lower(token)).otherwise(token).alias("own"), token.alias("t"), i.alias("enc"), F.element_at(signs, i + 1).alias("order")))


def _tested(x: Column) -> Column:
    token, enc, order = x["t"], x["enc"], x["order"]
    size, k = F.char_length(token), F.char_length(order).cast("double")
    places = F.transform(F.split(x["own"], ""), lambda c: (F.call_function("locate", c, order) - 1).cast("double"))
    kinds = F.translate(token, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", "U" * 26 + "l" * 26 + "d" * 10 + "s" * 5)
    switches = F.regexp_count(kinds, F.lit("U(?=[ds])|l(?=[Uds])|d(?=[Uls])"))
    first = F.struct(places.alias("p"), F.split(F.lower(token), "").alias("folded"), size.cast("double").alias("n"), k.alias("k"), enc.alias("enc"), switches.cast("double").alias("w"))
    return let(let(let(first, _counted), _moments), _verdict)


def _counted(x: Column) -> Column:
    """Adds the mean place, the halves and the counts of the characters."""
    same = lambda p: F.size(F.filter(x["p"], lambda q: q == p)).cast("double")
    return F.struct(
        x.alias("x"),
        (_sum(x["p"]) / x["n"]).alias("middle"),
        F.transform(x["p"], lambda p: F.when(p * 2 < x["k"], 1.0).otherwise(0.0)).alias("half"),
        F.transform(F.array_distinct(x["p"]), same).alias("counts"),
        F.transform(F.array_distinct(x["folded"]), lambda c: F.size(F.filter(x["folded"], lambda q: q == c)).cast("double")).alias("letters"),
    )


def _moments(y: Column) -> Column:
    """Sums that the tests need, each made once."""
    p, later = y["x"]["p"], F.sequence(F.lit(1), F.size(y["half"]) - 1)
    return F.struct(
        y["x"].alias("x"),
        F.aggregate(y["counts"], F.lit(0.0), lambda s, c: s + c * c).alias("squares"),
        F.aggregate(y["letters"], F.lit(0.0), lambda s, c: s + c * c).alias("alike"),
        _sum(y["half"]).alias("ones"),
        F.aggregate(later, F.lit(0.0), lambda s, i: s + F.abs(F.get(y["half"], i) - F.get(y["half"], i - 1))).alias("turns"),
        F.aggregate(p, F.lit(0.0), lambda s, v: s + (v - y["middle"]) * (v - y["middle"])).alias("around"),
        F.aggregate(later, F.lit(0.0), lambda s, i: s + (F.get(p, i) - y["middle"]) * (F.get(p, i - 1) - y["middle"])).alias("lag"),
    )


def _verdict(m: Column) -> Column:
    x, squares, ones = m["x"], m["squares"], m["ones"]
    n, k = x["n"], x["k"]
    # 1. chi-squared of uniformity, made normal as by Wilson and Hilferty
    chi, f = k / n * squares - n, k - 1
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / f, F.lit(1 / 3)) - (1 - 2 / (9 * f))) / F.sqrt(2 / (9 * f))
    # 2. runs of the halves of the alphabet
    mean = 1 + 2 * ones * (n - ones) / n
    z_runs = (m["turns"] + 1 - mean) / F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
    # 3. serial correlation of places
    z_serial = (F.when(m["around"] > 0, m["lag"] / m["around"]).otherwise(1.0) + 1 / n) * F.sqrt(n)
    # The null of the discoveries: natural text
    z_agree = (TEXT_AGREE - (m["alike"] - n) / (n * (n - 1))) / F.sqrt(F.lit(2 * TEXT_AGREE) / (n * (n - 1)) + F.lit(4 * 0.0009) / n)
    expected = TEXT_SWITCH * (n - 1)
    z_switch = (x["w"] - expected) / F.sqrt(expected * (1 - TEXT_SWITCH))
    tails = F.struct(
        _normal_tail(z_chi).alias("counts"),
        # runs and serial correlation read the same order of characters: Bonferroni
        (2 * F.least(2 * _normal_tail(F.abs(z_runs)), 2 * _normal_tail(F.abs(z_serial)))).alias("order"),
        _normal_tail(z_agree).alias("agree"),
        _normal_tail(z_switch).alias("switch"),
    )

    def fisher(p: Column, q: Column) -> Column:
        """Of a test of the counts and one of the order: counts say nothing of the order."""
        return let(F.least(p, F.lit(1.0)) * F.least(q, F.lit(1.0)), lambda w: w * (1 - F.log(w)))

    return let(tails, lambda v: F.struct(x["enc"].alias("enc"), n.cast("int").alias("n"), fisher(v["counts"], v["order"]).alias("p_random"), fisher(v["agree"], v["switch"]).alias("p_text")))


def stratum(enc: Column, n: Column) -> Column:
    """Alphabet and length class (powers of two, all over 4096 together)."""
    return enc * 16 + F.least(F.floor(F.log2(n.cast("double"))), F.lit(12)).cast("int")


def _bin(p: Column) -> Column:
    """0 for the least p-values; the upper edge of bin b is 10 ** ((b + 1 - BINS) / DECADE)."""
    return F.least(F.greatest(F.floor(F.log10(F.greatest(p, F.lit(1e-30))) * DECADE) + BINS, F.lit(0)), F.lit(BINS - 1)).cast("int")


def candidates(text: Column) -> Column:
    """Spans of token runs with their tests, as array of structs."""
    runs = _spans(text, CANDIDATE, 3)
    return F.transform(runs, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), battery(x["t"]).alias("b")))


def thresholds(found: DataFrame, rate: float = RATE) -> Column:
    """map<stratum, last bin reported> by Benjamini-Hochberg, as a scalar.

    ``found`` has a column ``c`` of candidates.  At most 14 * 13 strata of ``BINS``
    bins leave the aggregation.
    """
    one = found.select(F.explode("c").alias("c")).select(stratum(F.col("c.b.enc"), F.col("c.b.n")).alias("st"), _bin(F.col("c.b.p_text")).alias("bin"))
    counts = one.groupBy("st", "bin").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(W.partitionBy("st").orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("n").over(W.partitionBy("st"))
    edge = F.pow(F.lit(10.0), (F.col("bin") + 1 - BINS) / DECADE)
    ranked = counts.select("st", "bin", running.alias("rank"), total.alias("m"), edge.alias("p"))
    last = ranked.filter(F.col("p") <= F.lit(rate) * F.col("rank") / F.col("m")).groupBy("st").agg(F.max("bin").alias("last"))
    return last.agg(F.map_from_entries(F.collect_list(F.struct("st", "last")))).scalar()


def scan_secrets(docs: DataFrame, text_col: str = "text", rate: float = RATE) -> DataFrame:
    """``docs`` with ``secrets``, an array of (kind, start, end) sorted by start.

    Offsets are code points, ends exclusive; equal starts follow the order of
    ``KINDS``.  Patterns give assign, access and hex, each leftmost and without
    overlaps within its kind; the tests give ``random``, which may overlap those.
    Null and empty texts have none.  Whole texts are scanned, of any length.  The
    new column replaces an input column of that name; repeated rows are scanned
    each, and each counts for the discovery rate.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    limits = thresholds(docs.select(candidates(text).alias("c")), rate)
    key = PRIVATE + "limits"
    rest = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != "secrets"))
    # An absent stratum has no key: get -1, which no bin is below.
    spans = rest.withColumn(key, limits).withColumn(PRIVATE + "base", base_spans(text)).withColumn(PRIVATE + "more", candidates(text))

    def reported(x: Column) -> Column:
        b = x["b"]
        last = F.coalesce(F.try_element_at(F.col(key), stratum(b["enc"], b["n"])), F.lit(-1))
        return (b["p_random"] >= ALPHA) & (_bin(b["p_text"]) <= last)

    more = F.transform(F.filter(F.col(PRIVATE + "more"), reported), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(3).alias("k")))
    base = F.transform(F.col(PRIVATE + "base"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k")))
    ordered = F.transform(F.array_sort(F.transform(F.concat(base, more), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))), lambda x: F.struct(F.element_at(F.array(*(F.lit(k) for k in KINDS)), x["k"] + 1).alias("kind"), x["s"].alias("start"), x["e"].alias("end")))
    return spans.select(*rest.columns, ordered.alias("secrets"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_secret_scans(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = scan_secrets(docs)
    number = lambda k: F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = joined(F.filter("secrets", lambda x: x["kind"] != "random"))
    return out.select("doc_id", *(number(k) for k in KINDS[:3]), F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
