"""Secret scans with a battery of randomness tests (operator 7). DataFrame functions only.

Three plain patterns give the base spans: assignments to telling names, access keys and long hexadecimal runs. The
battery looks at every run of encoding characters outside the base spans that can carry ``min_bits`` bits and does not
consist of words alone (runs of words have no digit and their capitals at the start only, or nothing but capitals). A run
that holds separators of base64 (+ and /) as well as of base64url (- and _) has no encoding; it is cut at the ones and, once
more, at the others, and all parts are tested, since either kind may belong to a secret. The battery infers the encoding from the characters, turns them into symbol numbers and tests them against random draws from that alphabet:
chi-squared of the symbol counts (standardised with the exact moments for the run's length, since expected counts are
far below one), runs above and below the middle, and the correlation of neighbours. Fisher's method joins the three.

Two hypotheses are tested. A run that the battery shows not to be random is none. Of the others, those count as secrets that could not
well be text: under the model that a run's letters are drawn like those of the texts' own words (of all texts that hold a
tested run, without their runs and base spans; capitals count as small letters, as names have them anywhere) and a share of at least ``DIGIT_SHARE`` of its
characters are digits, the run's log-likelihood is compared with what its length lets expect. Both
decisions are made for all runs together, per encoding and class of length, by the Benjamini-Hochberg rule: the share of
random runs among those discarded, and of text-like ones among those reported, stays below ``fdr`` as far as the models hold, and short runs, on which
the tests have little power, do not set the bar for long ones. Where the texts hold no words, the battery decides alone.
P-values are counted in fine steps, so only step counts are gathered; a step counts with its upper end. Runs that
carry fewer than ``min_bits`` bits in their encoding are left out, as no test could tell; the shortest length follows from it.

Spans are in code points, end exclusive. Positions come from the lengths of the matches and of what lies between them. All
work on a text is linear in its length and its matches, so a very long text with very many matches is one row like any other.

Defined results: a null text counts as empty and has no spans. Repeated rows get equal results. An added span never
overlaps a base one, and added spans that overlap each other become one. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.llm.common import keep_columns, texts
from crosswalk.session import cut

# The patterns of the base spans, in the order in which equal starts are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+"
# What a run with both kinds of separators falls into: runs of base64url, and runs of base64.
PARTS = (r"[A-Za-z0-9_-]{%d,}+", r"[A-Za-z0-9+/]{%d,}+")
# Words: capitals only, or lower-case letters after at most one capital, also joined by separators or as in camelCase.
WORDS = r"[+/_-]+|(?<![A-Za-z])(?:[A-Z]++|[A-Za-z])(?![A-Za-z])|[A-Z]?[a-z]{2,}+"
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Encodings, the narrowest first: pattern of the characters, alphabet.
ENCODINGS = {
    "digits": ("^[0-9]+$", DIGITS),
    "hex": ("^[0-9a-f]+$", DIGITS + "abcdef"),
    "HEX": ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    "base32": ("^[A-Z2-7]+$", UPPER + "234567"),
    "base36": ("^[a-z0-9]+$", DIGITS + LOWER),
    "base62": ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    "base64": ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    "base64url": ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
}
DIGIT_SHARE = 0.1  # of the characters of names, where the texts' words have fewer
CLASSES = (19, 32, 64, 128)  # upper ends of the classes of length
LEAF = 64  # elements that are added up one by one
BLOCK = 1_024  # characters of a block of a text
STEPS = 20  # steps of p-values per power of ten
LEAST_P = 1e-300

SPAN = "struct<start:int,kind:int,end:int,text:string>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` with a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def before_each(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array, all elements before it added up.

    Sums of ``LEAF`` elements are added up first, and sums of those, so an element costs a few times ``LEAF`` steps however long the
    array is, and nothing is appended to an array element by element.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, b: add(a, b))

    def sums(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / LEAF).cast("int"))
        return F.when(F.size(v) > 0, F.transform(blocks, lambda b: total(F.slice(v, b * LEAF + 1, F.lit(LEAF))))).otherwise(v)

    def inside(v: Column, above: Column) -> Column:
        return F.transform(v, lambda x, i: add(F.get(above, F.floor(i / LEAF).cast("int")), total(F.slice(v, i - i % LEAF + 1, i % LEAF))))

    def levels(v: Column) -> Column:
        def upper(one: Column) -> Column:
            top = lambda two: F.transform(two, lambda x, i: total(F.slice(two, F.lit(1), i)))
            return let(sums(one), lambda two: let(top(two), lambda done: inside(one, done)))

        return let(sums(v), lambda one: let(upper(one), lambda done: inside(v, done)))

    return let(values, levels)


def located(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Spans of all matches; ``text`` is the match, or its ``group``. The work is linear in the text and the matches."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")

    def spans(found: Column) -> Column:
        inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

        def placed(between: Column, shown: Column, done: Column) -> Column:
            start = lambda i: (F.get(done, i) + F.length(F.get(between, i))).cast("int")
            return F.transform(found, lambda m, i: F.struct(start(i).alias("start"), F.lit(kind).alias("kind"), (start(i) + F.length(m)).alias("end"), F.get(shown, i).alias("text")))

        widths = lambda between: F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: F.length(b) + F.length(m))
        return let(F.split(text, pattern, -1), lambda between: let(inner, lambda shown: let(
            before_each(widths(between), F.lit(0), lambda a, b: a + b), lambda done: placed(between, shown, done)
        )))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(none))


def chains(spans: Column) -> Column:
    """(start, end) of each chain of overlapping spans, which are sorted by start."""

    def joined(every: Column, reach: Column) -> Column:
        heads = F.filter(F.transform(every, lambda s, i: F.struct(s["start"].alias("start"), F.get(reach, i).alias("reach"))), lambda h: h["start"] >= h["reach"])
        most = F.array_max(F.transform(every, lambda s: s["end"]))
        # What the spans before the next head reach is where this head's chain ends.
        return let(heads, lambda h: let(most, lambda end: F.transform(h, lambda x, i: F.struct(x["start"].alias("start"), F.coalesce(F.get(h, i + 1)["reach"], end).alias("end")))))

    reach = lambda every: before_each(F.transform(every, lambda s: s["end"]), F.lit(-1), lambda a, b: F.greatest(a, b))
    return let(spans, lambda every: let(reach(every), lambda r: joined(every, r)))


def with_gaps(text: Column, covers: Column, put: Callable[[Column], Column]) -> Column:
    """The text with ``put(cover)`` in place of each cover; covers are sorted and do not overlap.

    The text is cut into blocks, so that a stretch is looked up near its place instead of from the start of the text.
    """

    def stretch(blocks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / BLOCK).cast("int")
        last = F.floor((end - 1) / BLOCK).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return F.when(end > start, F.substring(near, start - first * BLOCK + 1, end - start)).otherwise(F.lit(""))

    def built(all_covers: Column, blocks: Column, size: Column) -> Column:
        begin = lambda i: F.coalesce(F.get(all_covers, i - 1)["end"], F.lit(0))
        pieces = F.transform(all_covers, lambda c, i: F.concat(stretch(blocks, F.when(i > 0, begin(i)).otherwise(F.lit(0)), c["start"]), put(c)))
        return F.concat(F.array_join(pieces, ""), stretch(blocks, F.element_at(all_covers, -1)["end"], size))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    done = lambda c: let(blocks, lambda b: let(F.length(text), lambda n: built(c, b, n)))
    return let(covers, lambda c: F.when(F.size(c) > 0, done(c)).otherwise(text))


def normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a logistic fit (within 0.0002; the far tail is too heavy)."""
    z = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), z))
    return F.greatest(F.lit(LEAST_P), 1 / (1 + F.exp(0.07056 * F.pow(z, 3) + 1.5976 * z)))


def encoding(run: Column) -> Column:
    chosen = None
    for name, (pattern, _) in reversed(ENCODINGS.items()):
        chosen = F.when(run.rlike(pattern), F.lit(name)).otherwise(chosen) if chosen is not None else F.when(run.rlike(pattern), F.lit(name))
    return chosen


def tested(span: Column) -> Column:
    """A run's span with its ``encoding``, alphabet size and the sums that the tests need."""
    run = span["text"]
    name = encoding(run)
    alphabet = F.element_at(F.create_map(*[F.lit(x) for k, (_, a) in ENCODINGS.items() for x in (k, a)]), name)
    chars = F.split(run, "(?<=.)(?=.)", -1)
    values = F.transform(chars, lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    half = F.length(alphabet) / 2.0
    square = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc + F.pow((F.length(run) - F.length(F.replace(run, c, F.lit("")))).cast("double"), F.lit(2.0)))
    zero = {k: F.lit(0.0) for k in ("s", "ss", "sp", "high", "turns")}

    def step(acc, v):
        first = acc.last < 0
        high = F.when(v >= half, 1.0).otherwise(0.0)
        turn = F.when(first | ((acc.last >= half) == (v >= half)), 0.0).otherwise(1.0)
        return F.struct(
            v.alias("last"), (acc.s + v).alias("s"), (acc.ss + v * v).alias("ss"), (acc.sp + F.when(first, 0.0).otherwise(acc.last * v)).alias("sp"), (acc.high + high).alias("high"), (acc.turns + turn).alias("turns"),
            F.when(first, v).otherwise(acc.first).alias("first"),
        )

    start = F.struct(F.lit(-1.0).alias("last"), *[c.alias(k) for k, c in zero.items()], F.lit(-1.0).alias("first"))
    sums = F.aggregate(values, start, step)
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), symbol_counts(run).alias("counts"), name.alias("encoding"), F.length(alphabet).cast("double").alias("k"), F.length(run).cast("double").alias("n"), square.alias("square"), sums.alias("sums"))


def symbol_counts(text: Column) -> Column:
    """How often each letter occurs, and, last, digits."""
    letters = F.array(*[F.lit(c) for c in LOWER])
    counts = lambda t: F.transform(letters, lambda c: F.length(t) - F.length(F.replace(t, c, F.lit(""))))
    digits = F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))
    return F.concat(let(F.lower(text), counts), F.array(digits))


def text_step(counts: Column, words: Column) -> Column:
    """The step of the p-value of a run's likelihood as text; ``words`` counts the symbols of the texts' words."""
    n_letters = len(LOWER)

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    def p(share: Column) -> Column:
        logs = F.transform(share, lambda q, i: F.log(q / F.when(i < n_letters, 1).otherwise(10)))  # a digit is one of ten
        mean = total(F.zip_with(share, logs, lambda q, g: q * g))
        variance = total(F.zip_with(share, logs, lambda q, g: q * g * g)) - mean * mean
        n = F.aggregate(counts, F.lit(0), lambda a, b: a + b).cast("double")
        found = total(F.zip_with(counts, logs, lambda c, g: c * g))
        return F.when(n > 0, normal_tail((n * mean - found) / F.sqrt(n * variance))).otherwise(1.0)

    def shares(every: Column) -> Column:
        digits = F.greatest(F.lit(DIGIT_SHARE), F.get(words, F.lit(n_letters)) / every)
        letters = every - F.get(words, F.lit(n_letters))
        return F.transform(words, lambda c, i: F.when(i < n_letters, (1 - digits) * (c + 1) / (letters + n_letters)).otherwise(digits))

    every = F.aggregate(words, F.lit(0).cast("long"), lambda a, b: a + b)
    some = F.aggregate(F.slice(words, 1, n_letters), F.lit(0).cast("long"), lambda a, b: a + b) > 0
    judged = let(let(every, shares), p)
    return F.floor(-F.log10(F.when(some, judged).otherwise(F.lit(LEAST_P))) * STEPS).cast("int")


def p_value(x: Column) -> Column:
    """Fisher's joint p-value of the three tests."""
    n, k, sums = x["n"], x["k"], x["sums"]
    chi = (k / n * x["square"] - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    high, low = sums["high"], n - sums["high"]
    pairs = 2 * high * low
    spread = pairs * (pairs - n) / (n * n * (n - 1))
    runs = F.when(spread <= 0, F.lit(2.0) * F.pow(F.lit(0.5), F.least(n, F.lit(900.0)))).otherwise(2 * normal_tail(F.abs(sums["turns"] + 1 - (pairs / n + 1)) / F.sqrt(spread)))
    mean = sums["s"] / n
    variance = sums["ss"] - n * mean * mean
    # Sum over neighbours of the products of what is left without the mean.
    neighbours = sums["sp"] - mean * (2 * sums["s"] - sums["first"] - sums["last"]) + (n - 1) * mean * mean
    serial = F.when(variance <= 1e-9, F.lit(LEAST_P)).otherwise(2 * normal_tail(F.abs(neighbours / variance + 1 / (n - 1)) * F.sqrt(n - 1)))
    half = -(F.log(normal_tail(chi)) + F.log(F.greatest(F.lit(LEAST_P), F.least(F.lit(1.0), runs))) + F.log(F.greatest(F.lit(LEAST_P), F.least(F.lit(1.0), serial))))
    return F.greatest(F.lit(LEAST_P), F.exp(-half) * (1 + half + half * half / 2))


def graded(x: Column) -> Column:
    """A tested run as span, stratum and step of its p-value (0: p above 10^(-1/STEPS))."""
    size = F.concat(*[F.when(x["n"] > c, F.lit("+")).otherwise(F.lit("")) for c in CLASSES])
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["counts"].alias("counts"), F.concat(x["encoding"], size).alias("stratum"), F.floor(-F.log10(p_value(x)) * STEPS).cast("int").alias("step"))


def blanked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of the characters in ``spans``, which are sorted."""
    return with_gaps(text, chains(spans), lambda c: F.repeat(F.lit(" "), c["end"] - c["start"]))


def least_length(min_bits: float) -> int:
    """Length below which no run of the widest alphabet carries ``min_bits`` bits."""
    return max(2, math.ceil(min_bits / math.log2(max(len(a) for _, a in ENCODINGS.values()))))


def is_mixed(run: Column) -> Column:
    """The run holds separators of both kinds, so its characters have no encoding."""
    return run["text"].rlike("[+/]") & run["text"].rlike("[_-]")


def merged(spans: Column) -> Column:
    """Sorted (start, kind, end) of kind 3 with each chain of overlapping ones as one."""
    return F.transform(chains(F.array_sort(spans)), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))


def candidates(docs: DataFrame, min_bits: float, keep: Sequence[str]) -> DataFrame:
    """Rows with their base spans and graded runs."""
    text, least = F.coalesce(F.col("text"), F.lit("")), least_length(min_bits)
    out = texts(docs, *keep_columns(docs, keep)).withColumn("_all", text)
    out = out.withColumn("_assign", F.filter(located(F.col("_all"), ASSIGN, 0, 2), lambda s: F.length(s["text"]) >= 6))
    out = out.withColumn("_access", F.filter(located(F.col("_all"), ACCESS, 1), lambda s: F.length(s["text"]) >= 20))
    out = out.withColumn("_hex", located(F.col("_all"), HEX.replace("+", "{24,}"), 2))
    base = F.concat("_assign", "_access", "_hex")
    out = out.withColumn("_base", F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))))
    out = out.withColumn("_all", blanked(F.col("_all"), F.col("_base")))
    out = out.withColumn("_run", located(F.col("_all"), RUN % least, 3))
    # Runs with both kinds of separators: all others are blanked, and what lies between separators of either kind is left.
    plain = F.filter("_run", lambda r: ~is_mixed(r))
    out = out.withColumn("_mixed", F.when(F.exists("_run", is_mixed), blanked(F.col("_all"), plain)).otherwise(F.lit("")))
    out = out.withColumn("_run", F.concat(plain, *[located(F.col("_mixed"), p % least, 3) for p in PARTS])).drop("_mixed")
    out = out.withColumn("_run", F.filter("_run", lambda s: F.length(F.regexp_replace(s["text"], WORDS, "")) > 0))
    out = out.withColumn("_tested", F.transform("_run", tested))
    known = F.filter("_tested", lambda x: x["n"] * F.log2(x["k"]) >= min_bits)
    out = out.withColumn("_known", known).withColumn("_graded", F.transform("_known", graded))
    covers = F.array_sort(F.transform("_known", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    words = F.when(F.size("_known") > 0, let(blanked(F.col("_all"), covers), symbol_counts))  # of the text's words, where there is a run to judge
    out = out.withColumn("_words", words).drop("_all")
    counts = [F.size(c).cast("long").alias(n) for n, c in (("n_assign", "_assign"), ("n_access", "_access"), ("n_hex", "_hex"))]
    kept = ["text"] if "text" in keep else []
    return out.select("doc_id", *kept, *keep_columns(docs, keep), "_base", "_graded", "_words", *counts)


def least_steps(rows: DataFrame, step: str, fdr: float) -> DataFrame:
    """One row with a map from stratum to the smallest step that the rule rejects."""
    steps = rows.select(F.explode("_graded").alias("g")).groupBy("g.stratum", F.col(f"g.{step}").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    per = F.transform(F.array_sort(F.collect_list(F.struct("step", "n"))), lambda x: x)
    lists = steps.groupBy("stratum").agg(per.alias("steps"), F.sum("n").alias("m"))

    def enough(s, steps, m):
        reached = F.aggregate(F.filter(steps, lambda t: t["step"] >= s["step"]), F.lit(0).cast("long"), lambda acc, t: acc + t["n"])
        return F.pow(F.lit(10.0), -s["step"] / F.lit(float(STEPS))) <= F.lit(fdr) * reached / m

    passing = F.filter("steps", lambda s: enough(s, F.col("steps"), F.col("m")))
    least = lists.select("stratum", F.array_min(F.transform(passing, lambda s: s["step"])).alias("least")).filter(F.col("least").isNotNull())
    return least.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "least"))).alias("least"))


def scan(docs: DataFrame, min_bits: float = 80.0, fdr: float = 0.01, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns in ``keep``, ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base`` and
    ``spans``: arrays of (start, kind, end) by start, then kind; ``kind`` counts in ``KINDS``.

    Texts are read once; what was found is stored and read again for the decision on all runs together.
    """
    rows = cut(candidates(docs, min_bits, keep), "secret-runs")
    words = rows.agg(F.array(*[F.coalesce(F.sum(F.get("_words", F.lit(i))), F.lit(0)) for i in range(len(LOWER) + 1)]).alias("words")).scalar()
    judged = F.transform("_graded", lambda g: F.struct(*[g[n].alias(n) for n in ("start", "end", "stratum", "step")], text_step(g["counts"], F.col("_all_words")).alias("text_step")))
    rows = rows.withColumn("_all_words", words).withColumn("_graded", judged).drop("_words", "_all_words")
    least, text_least = least_steps(rows, "step", fdr).scalar(), least_steps(rows, "text_step", fdr).scalar()
    random = F.filter("_graded", lambda g: F.coalesce(g["step"] < F.element_at(F.col("_least"), g["stratum"]), F.lit(True)) & F.coalesce(g["text_step"] >= F.element_at(F.col("_text"), g["stratum"]), F.lit(False)))
    added = F.transform(random, lambda g: F.struct(g["start"].alias("start"), F.lit(3).alias("kind"), g["end"].alias("end")))
    out = rows.withColumns({"_least": least, "_text": text_least}).withColumn("_added", merged(added))
    held = [c for c in rows.columns if c not in ("doc_id", "_base", "_graded", "n_assign", "n_access", "n_hex")]
    return out.select("doc_id", *held, "n_assign", "n_access", "n_hex", F.size("_added").cast("long").alias("n_random"), F.col("_base").alias("base"), F.array_sort(F.concat("_base", "_added")).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or each chain of overlapping spans, replaced by ``mark``."""

    return with_gaps(text, chains(spans), lambda c: F.lit(mark))
