"""Column expressions shared by the operators. All are built-in Spark expressions; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, object]


def lit_or_col(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def first_match(rules: Sequence[Rule], default: object = None) -> Column:
    """ordered first-match rules; a condition that is NULL does not match."""
    out = None
    for condition, value in rules:
        out = F.when(condition, lit_or_col(value)) if out is None else out.when(condition, lit_or_col(value))
    return F.lit(default) if out is None else out.otherwise(lit_or_col(default))


def any_of(conditions: Sequence[Column]) -> Column:
    """OR of conditions in which NULL counts as no match."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def count_if(condition: Column) -> Column:
    """Rows meeting a condition; 0, not NULL, for none."""
    return F.count(F.when(condition, F.lit(1)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 x part / whole as a rounded double; NULL when ``whole`` is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits)


def mean(value: Column, digits: int = 4) -> Column:
    """Average from an exact sum (give decimals or integers), so the result does not depend on row order."""
    return F.round(F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double")), digits)


def moment(value: datetime | str) -> Column:
    """A literal point in time without zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def elapsed(start: Column, end: Column, unit: str) -> Column:
    """Whole units from start to end, truncated toward zero."""
    size = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit] * 1_000_000
    return ((micros(end) - micros(start)) / F.lit(size)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)).cast("double") / F.lit(3_600_000_000.0)


def day_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def week_text(ts: Column) -> Column:
    return F.date_trunc("week", ts).cast("date").cast("string")


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def keyword_match(column: Column, kind: str, pattern: str) -> Column:
    """One text rule on lower-cased text: contains, starts, ends, like, regex or equals."""
    text = F.lower(column)
    return {
        "contains": lambda: text.contains(pattern),
        "starts": lambda: text.startswith(pattern),
        "ends": lambda: text.endswith(pattern),
        "like": lambda: text.like(pattern),
        "regex": lambda: text.rlike(pattern),
        "equals": lambda: text == pattern,
    }[kind]()


def flag_total(flags: Sequence[str | Column]) -> Column:
    """number of true flags in a row; NULL counts as false."""
    cols = [F.col(f) if isinstance(f, str) else f for f in flags]
    return reduce(lambda a, b: a + b, [F.coalesce(c.cast("int"), F.lit(0)) for c in cols])


def codes_present(code: Column, codes: Sequence[str], condition: Column | None = None, separator: str = ", ") -> tuple[Column, Column]:
    """Aggregates over rows: those of ``codes`` that occur (where ``condition`` holds) as sorted text, and how many they are.

    One flag per given code: unlike a set gathered from the rows, it can't grow with them.
    """
    seen = [F.max(F.when((code == c) if condition is None else ((code == c) & condition), F.lit(c))) for c in sorted(codes)]
    return F.concat_ws(separator, *seen), reduce(lambda a, b: a + b, [s.isNotNull().cast("int") for s in seen])


def recency_bucket(age_days: Column, edges: Sequence[tuple[int, str]], beyond: str, missing: str | None = None) -> Column:
    """first label whose edge is not exceeded by the age."""
    rules: list[Rule] = [(age_days.isNull(), missing)] + [(age_days <= edge, label) for edge, label in edges]
    return first_match(rules, beyond)


def ordered_label(column: Column, order: Sequence[str]) -> Column:
    """Position of a label in a fixed order; unknown labels come last."""
    return first_match([(column == label, i) for i, label in enumerate(order, 1)], len(order) + 1)


# Roman digits, and the form of a Roman number written by the rules.
ROMAN_DIGITS = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
ROMAN = "m*(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})(?<=[ivxlcdm])"
# Accented Latin letters and what they are compared as.
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def roman_value(word: Column) -> Column:
    """Value of a lower-case Roman number: a digit before a larger one counts against it. NULL for other text."""
    digits = F.transform(F.split(word, "(?<=.)(?=.)"), lambda c: F.element_at(F.create_map(*[F.lit(x) for d in ROMAN_DIGITS.items() for x in d]), c).cast("bigint"))
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("last"))

    def add(acc: Column, v: Column) -> Column:
        return F.struct((acc["total"] + v - F.when(acc["last"] < v, 2 * acc["last"]).otherwise(0)).alias("total"), v.alias("last"))

    return F.when(word.rlike(f"^{ROMAN}$"), F.aggregate(digits, start, add, lambda acc: acc["total"]))


def series_number(column: Column, marker: str = "phase", legacy: bool = False) -> Column:
    """F8: number of a series member, arabic or roman, standing as a whole word after the marker.

    ``legacy`` keeps the older reading: ``<marker> 1`` .. ``<marker> 5`` as a substring first, then any arabic
    number after the marker; no roman numbers, 0 when nothing is found.
    """
    text = F.lower(column)
    if legacy:
        rules = [(text.contains(f"{marker} {i}"), i) for i in range(1, 6)]
        digits = F.regexp_extract(text, rf"{marker}\s*([0-9]+)", 1)
        return F.coalesce(first_match(rules), digits.try_cast("bigint"), F.lit(0))
    word = F.regexp_extract(text, rf"\b{marker}\s*([0-9]+|{ROMAN})\b", 1)
    return F.coalesce(word.try_cast("bigint"), roman_value(word))


def series_base(column: Column, marker: str = "phase") -> Column:
    """F8: name without the marker, its number and everything that is not a letter or digit."""
    text = F.regexp_replace(F.lower(column), rf"\b{marker}\s*([0-9]+|{ROMAN})\b", "")
    return letters_and_digits(text)


def letters_and_digits(column: Column, also: str = "") -> Column:
    """Lower-cased letters and digits of any script, accents of Latin letters folded, and the characters ``also``."""
    return F.regexp_replace(F.translate(F.lower(column), ACCENTED, PLAIN), rf"[^\p{{L}}\p{{M}}\p{{N}}{also}]", "")


def clean_key(column: Column) -> Column:
    """Upper-cased, trimmed text; blank becomes NULL."""
    text = F.upper(F.trim(column))
    return F.when(text != "", text)


def zip5(column: Column) -> Column:
    """First five characters of a postal code, left-padded with zeros."""
    text = F.trim(column)
    return F.when(text != "", F.lpad(F.substring(text, 1, 5), 5, "0"))


def address_key(street: Column, city: Column, state: Column, postal: Column) -> Column:
    """Hash of the normalised address; NULL when any part is missing, so such rows never count as duplicates."""
    parts = [clean_key(street), clean_key(city), clean_key(state), zip5(postal)]
    return F.when(all_of([p.isNotNull() for p in parts]), F.sha1(F.concat_ws("\u0001", *parts)))


def norm_name(column: Column) -> Column:
    """Lower-case letters, digits and single spaces; blank becomes NULL."""
    text = F.trim(letters_and_digits(F.trim(column), " "))
    return F.when(text != "", text)


def norm_email(column: Column) -> Column:
    """Lower-case; dots and a plus tag are dropped from the part before the at sign."""
    text = F.lower(F.trim(column))
    user = F.regexp_replace(F.regexp_replace(F.substring_index(text, "@", 1), r"\+.*$", ""), r"\.", "")
    return F.when(text.contains("@"), F.concat(user, F.lit("@"), F.substring_index(text, "@", -1)))


def norm_phone(column: Column) -> Column:
    """Digits only; blank becomes NULL."""
    text = F.regexp_replace(column, "[^0-9]", "")
    return F.when(text != "", text)


def norm_value(column: Column, kind: str = "text") -> Column:
    """M7: comparable text of a value. Blank and the word null become NULL; bool words and dates are unified."""
    text = F.trim(column.cast("string"))
    text = F.when((text != "") & (F.lower(text) != "null"), text)
    if kind == "bool":
        low = F.lower(text)
        return first_match([(low.isin("true", "t", "1", "yes"), "true"), (low.isin("false", "f", "0", "no"), "false")], text)
    if kind == "date":
        return F.substring(text, 1, 10)
    return text
