"""Secret spans by patterns and by a randomness test battery, in DataFrame functions only.

Base spans are pattern matches.  Beside them, every long unbroken stretch is a candidate.  Its encoding is inferred from its
characters (hex, base32 or base64), and three tests ask whether it looks like uniform draws from that alphabet: the
chi-squared statistic of its symbol counts, the number of runs above and below the alphabet's middle, and the lag-one serial
correlation of symbol values.  The last two must not reject randomness.  The chi-squared statistic becomes evidence by its
lower tail under text: were the stretch drawn from the shares that its encoding's symbols have in ordinary words, the statistic would be
noncentral with a noncentrality that grows with length, so short stretches need to look more even than long ones to
count.  Ordinary words aren't under test, so a corpus of many secrets makes none of them look like text.  Benjamini and Hochberg's step-up over all candidates of the corpus then holds the expected share of
text among the spans that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, texts

#: The patterns that base spans must match, in the order of their kinds.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Equal to the shortest-match-then-drop rule: the runs are maximal and none can begin inside a failed one.
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
LEAST_VALUE = 6
#: Candidates: maximal stretches of the base64 alphabets (the look-behind only says where they can begin).
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Ordinary words: short stretches of small letters with or without a capital, of capitals, or of digits; keys hardly ever are that.
ORDINARY = r"(?<![A-Za-z0-9+/_-])(?:[A-Z]?[a-z]{1,18}|[A-Z]{1,19}|[0-9]{1,19})(?![A-Za-z0-9+/_-])"
#: Words that are counted with those of the corpus, which may have none.
USUAL = (
    "It was a bright cold day in April and the clocks were striking thirteen when All of the people who had come to see what was going on went back "
    "to their houses In the year 1984 more than 200 of them lived there FOR SALE OR RENT BY THE OWNER NOTICE TO ALL WHO ENTER THIS PLACE Some had "
    "worked on it for 12 years while others did not know that anything had changed at all before the end of 2003 A new road was built next to the river"
)
#: Symbols of the inferred encodings, in order of value.
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
KINDS = ("assign", "access", "hex", "random")
#: Expected share of text among the added spans, and the level below which runs or serial correlation speak against randomness.
FALSE_DISCOVERY, AGAINST = 0.01, 0.001
#: p-values are put into bins of a hundredth of a power of ten, rounded up, before the step-up: so many at most.
MOST_BINS = 30_000


#: Elements that are summed up at a time.
RUN = 256


def _held(value: Column, use) -> Column:
    """use(value), where value is worked out once however often use has it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op) -> Column:
    """From numbers x0, x1, ... (0 or more, not null) the numbers x0, op(x0, x1), ...; op has 0 as its zero.

    A fold that appends copies all it has at each step; so short runs are folded each, then the runs' ends, and both are put together.
    """
    append = lambda a, x: F.concat(a, F.array(op(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0)), x)))
    none = F.array().cast("array<int>")

    def whole(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda i: F.aggregate(F.slice(v, i * RUN + 1, F.lit(RUN)), none, append))
        return _held(runs, lambda r: _held(F.aggregate(r, F.array(F.lit(0)), lambda a, x: append(a, F.get(x, F.size(x) - 1))), lambda before: F.flatten(F.transform(r, lambda x, i: F.transform(x, lambda y: op(F.get(before, i), y))))))

    return _held(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def matches(text: Column, pattern: str, group: int | None = None, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of (s, e, word), code points from 0 and the match; those whose group is
    shorter than ``least`` are dropped after matching.  Positions are running sums over the pieces between matches."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(x: Column) -> Column:
        ends = running(F.zip_with(F.slice(x["pieces"], F.lit(1), F.size(x["found"])), x["found"], lambda p, m: F.length(p) + F.length(m)), lambda a, b: a + b)
        rows = F.zip_with(F.arrays_zip(ends.alias("e"), x["found"].alias("m")), x["value"], lambda m, v: F.struct((m["e"] - F.length(m["m"])).alias("s"), m["e"].alias("e"), m["m"].alias("word"), F.length(v).alias("n")))
        return F.transform(F.filter(rows, lambda r: r["n"] >= least), lambda r: F.struct(r["s"].alias("s"), r["e"].alias("e"), r["word"].alias("word")))

    found = _held(F.struct(pieces.alias("pieces"), found.alias("found"), value.alias("value")), placed)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<s:int,e:int,word:string>>"))


def _two_sided(z: str) -> str:
    """P(|Z| > |z|) of the standard normal as SQL, to seven digits (Abramowitz and Stegun 26.2.17)."""
    t = f"(1 / (1 + 0.2316419D * abs({z})))"
    return f"(2 * exp(-({z}) * ({z}) / 2) * 0.3989422804014327D * {t} * (0.31938153D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D)))))"


def symbols(spans: DataFrame) -> DataFrame:
    """Rows with ``word`` -> with the inferred encoding, its size k and the values of the word's symbols in it."""
    alphabet = " ".join(f"WHEN encoding = '{name}' THEN '{a}'" for name, a in ALPHABETS.items())
    size = " ".join(f"WHEN encoding = '{name}' THEN {len(a)}" for name, a in ALPHABETS.items())
    return (
        spans.withColumn("encoding", F.expr("CASE WHEN word RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN 'hex' WHEN word RLIKE '^[A-Z2-7]+$' THEN 'base32' ELSE 'base64' END"))
        .withColumn("k", F.expr(f"CASE {size} END"))
        .withColumn("alphabet", F.expr(f"CASE {alphabet} END"))
        .withColumn("plain", F.expr("CASE WHEN encoding = 'hex' THEN lower(word) ELSE translate(word, '-_', '+/') END"))
        .withColumn("v", F.expr("transform(filter(split(plain, ''), c -> c != ''), c -> CAST(instr(alphabet, c) - 1 AS DOUBLE))"))
        .drop("alphabet")
    )


def ordinary(docs: DataFrame) -> DataFrame:
    """word: the ordinary words of all texts as often as they occur, and the usual ones, often enough to count where there is nothing else."""
    found = texts(docs).select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("word"))
    return found.unionByName(docs.sparkSession.range(1).select(F.explode(F.flatten(F.array_repeat(F.split(F.lit(USUAL), " "), 20))).alias("word")))


def background(spans: DataFrame) -> DataFrame:
    """encoding, excess: how far text is from uniform, k times the summed squares of (share - 1/k), where a symbol's share is
    its part, plus one, of all characters of all words that the encoding has.  A few rows, from counts of words."""
    seen = stored(spans.groupBy("word").count().select(F.explode(F.split("word", "")).alias("c"), "count").where("c != ''").groupBy("c").agg(F.sum("count").alias("count")), "symbols")
    parts = []
    for name, alphabet in ALPHABETS.items():
        symbol = "lower(c)" if name == "hex" else "translate(c, '-_', '+/')"
        all_symbols = F.explode(F.split(F.lit(alphabet), "")).alias("symbol")
        base = seen.sparkSession.range(1).select(all_symbols).where("symbol != ''")
        there = seen.groupBy(F.expr(symbol).alias("symbol")).agg(F.sum("count").alias("n"))
        shares = base.join(there, "symbol", "left").select((F.coalesce("n", F.lit(0)) + 1).cast("double").alias("n"))
        total = shares.agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("q"))
        parts.append(total.select(F.lit(name).alias("encoding"), (len(alphabet) * F.col("q") / (F.col("t") * F.col("t")) - 1).alias("excess")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def battery(found: DataFrame, text_like: DataFrame) -> DataFrame:
    """The tests of each candidate: chi2, p_runs, p_serial, and p, the chi-squared's lower tail under text (1 where runs or
    serial correlation reject randomness).  A stretch of one symbol has p_runs = p_serial = 0."""
    df = found.join(F.broadcast(text_like), "encoding").withColumn("n", F.size("v"))  # a row for each encoding
    df = df.withColumn("chi2", F.expr("k * aggregate(transform(array_distinct(v), x -> size(filter(v, y -> y = x))), 0D, (a, c) -> a + CAST(c AS DOUBLE) * c) / n - n"))
    df = df.withColumn("up", F.expr("transform(v, x -> IF(2 * x >= k, 1, 0))")).withColumn("n1", F.expr("aggregate(up, 0, (a, x) -> a + x)"))
    df = df.withColumn("runs", F.expr("1 + aggregate(zip_with(slice(up, 1, n - 1), slice(up, 2, n - 1), (x, y) -> IF(x = y, 0, 1)), 0, (a, x) -> a + x)"))
    df = df.withColumn("n12", F.expr("2D * n1 * (n - n1)")).withColumn("z_runs", F.expr("try_divide(runs - n12 / n - 1, sqrt(n12 * greatest(n12 - n, 0D) / (CAST(n AS DOUBLE) * n * (n - 1))))"))
    df = df.withColumn("mean", F.expr("aggregate(v, 0D, (a, x) -> a + x) / n")).withColumn("d", F.expr("transform(v, x -> x - mean)"))
    df = df.withColumn("square", F.expr("aggregate(d, 0D, (a, x) -> a + x * x)"))
    df = df.withColumn("z_serial", F.expr("(try_divide(aggregate(zip_with(slice(d, 1, n - 1), slice(d, 2, n - 1), (x, y) -> x * y), 0D, (a, x) -> a + x), square) + 1D / n) * sqrt(CAST(n AS DOUBLE))"))
    df = df.withColumn("p_runs", F.expr(f"IF(n1 = 0 OR n1 = n, 0D, {_two_sided('z_runs')})")).withColumn("p_serial", F.expr(f"IF(square = 0, 0D, {_two_sided('z_serial')})"))
    # Sankaran's transformation of the noncentral chi-squared
    df = df.withColumn("f", F.expr("CAST(k - 1 AS DOUBLE)")).withColumn("nc", F.expr("n * excess"))
    df = df.withColumn("h", F.expr("1 - 2 * (f + nc) * (f + 3 * nc) / (3 * (f + 2 * nc) * (f + 2 * nc))")).withColumn("q", F.expr("(f + 2 * nc) / ((f + nc) * (f + nc))")).withColumn("m", F.expr("(h - 1) * (1 - 3 * h)"))
    df = df.withColumn("z", F.expr("(pow(greatest(chi2, 0D) / (f + nc), h) - (1 + q * h * (h - 1 - 0.5 * (2 - h) * m * q))) / (h * sqrt(2 * q) * (1 + 0.5 * m * q))"))
    lower = f"IF(z < 0, {_two_sided('z')} / 2, 1 - {_two_sided('z')} / 2)"
    return df.withColumn("p", F.expr(f"IF(p_runs < {AGAINST} OR p_serial < {AGAINST}, 1D, greatest(1e-299D, {lower}))"))


def discoveries(tested: DataFrame, level: float = FALSE_DISCOVERY) -> DataFrame:
    """The rows of ``tested`` that Benjamini and Hochberg's step-up keeps at ``level``.

    p-values are rounded up to bins, and only counts of bins are put in order; one number reaches the driver.
    """
    tested = tested.withColumn("bin", F.least(F.floor(-F.log10("p") * 100), F.lit(MOST_BINS)).cast("int"))
    bins = tested.groupBy("bin").count()
    up = Window.orderBy(F.desc("bin"))
    ranked = bins.select("bin", F.sum("count").over(up).alias("i"), F.sum("count").over(Window.partitionBy()).alias("m"))
    least = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 100) <= F.col("i") * level / F.col("m")).agg(F.min("bin")).first()[0]
    return tested.where(F.col("bin") >= F.lit(MOST_BINS + 1 if least is None else least))


def _joined(spans: Column) -> Column:
    """(s, kind's number, e) in order as kind:start:end, with commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, *more: str) -> DataFrame:
    """Every row's secrets: doc_id, the columns ``more``, assign, access, hex, random: arrays of (s, e, word), base and random spans.

    Whole texts; null counts as empty.  Candidates that lie inside a base span aren't repeated.  The table is scanned for patterns, whose
    narrow result is stored, and for counts of ordinary words; only counts and candidates are shuffled, the latter by row.  Repeated rows each keep their spans; an empty table
    gives no rows.
    """
    source, text = texts(docs, *more), F.col("text")
    base = source.select("doc_id", *more, matches(text, ASSIGN, 2, LEAST_VALUE).alias("assign"), matches(text, ACCESS).alias("access"), matches(text, HEX).alias("hex"), matches(text, CANDIDATE).alias("stretch"), F.monotonically_increasing_id().alias("_row"))
    base = stored(base, "patterns")
    # a stretch lies in a base span if one of those that begin before it, or with it, reaches as far
    both = base.where("size(stretch) > 0").select("_row", F.explode(F.expr("concat(transform(concat(assign, access, hex), x -> struct(x.s, x.e, x.word, 0 AS own)), transform(stretch, x -> struct(x.s, x.e, x.word, 1 AS own)))")).alias("x")).select("_row", "x.*")
    reach = F.max(F.when(F.col("own") == 0, F.col("e"))).over(Window.partitionBy("_row").orderBy("s", "own").rowsBetween(Window.unboundedPreceding, 0))
    spans = both.withColumn("reach", reach).where("own = 1 AND (reach IS NULL OR reach < e)").select("_row", "s", "e", "word")
    added = discoveries(stored(battery(symbols(spans), background(ordinary(docs))).select("_row", "s", "e", "word", "p"), "battery"))
    added = added.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("s", "e", "word"))).alias("random"))
    return base.join(added, "_row", "left").select("doc_id", *more, "assign", "access", "hex", F.coalesce("random", F.array().cast("array<struct<s:int,e:int,word:string>>")).alias("random"))


def digest(found: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of scan()'s rows."""
    def kinds(name: str) -> Column:
        number = F.lit(KINDS.index(name))
        return F.transform(name, lambda x: F.struct(x["s"].alias("s"), number.alias("kind"), x["e"].alias("e")))

    ordered = {k: kinds(k) for k in KINDS}
    base = F.concat(*[ordered[k] for k in KINDS[:3]])
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *more, *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.concat(base, ordered["random"])).alias("spans"))


def masked(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret span of text replaced by ``mark`` (overlapping spans by one), columns as they are; null texts stay null.

    The text is cut at its merged spans: for each the piece before it, then the mark, and at the end what is left.
    """
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("whole_row")
    found = scan(docs.select("doc_id", "text", row), "whole_row")
    spans = F.expr("array_sort(transform(concat(assign, access, hex, random), x -> struct(x.s AS s, x.e AS e)))")
    new = F.when(F.size("assign") + F.size("access") + F.size("hex") + F.size("random") == 0, F.col("whole_row.text")).otherwise(_held(spans, lambda v: _without(F.col("whole_row.text"), v, mark)))
    return found.select(*[(new if c == "text" else F.col("whole_row").getField(c)).alias(c) for c in docs.columns])


def _without(text: Column, spans: Column, mark: str) -> Column:
    """text with ``mark`` for each stretch that the ordered spans (s, e), one at least, cover together.

    Spans that overlap others before them begin no piece of their own.  The text is cut into long parts first, each with a run of
    marks, so that no cut has to count its way through all of it.
    """
    ends = running(F.transform(spans, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    # (begin of the text that stays, its end): before each stretch, then what is left at the end
    starts = lambda reach: F.filter(F.transform(spans, lambda x, i: F.struct(F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0)).alias("b"), x["s"].alias("s"), (i == 0).alias("first"))), lambda x: x["first"] | (x["s"] >= x["b"]))

    def pieces(gaps: Column, last: Column) -> Column:
        def part(k: Column) -> Column:
            own = F.slice(gaps, k * RUN + 1, F.lit(RUN))
            begin = lambda o: F.get(o, F.lit(0))["b"]
            return _held(own, lambda o: _held(text.substr(begin(o) + 1, F.get(o, F.size(o) - 1)["s"] - begin(o)), lambda t: F.array_join(F.transform(o, lambda x: F.concat(t.substr(x["b"] - begin(o) + 1, x["s"] - x["b"]), F.lit(mark))), "")))

        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size(gaps) - 1) / RUN).cast("int")), part), ""), text.substr(last + 1, F.length(text)))

    return _held(ends, lambda reach: _held(starts(reach), lambda gaps: pieces(gaps, F.get(reach, F.size(reach) - 1))))
