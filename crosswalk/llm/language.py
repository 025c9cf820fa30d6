"""Language identification by words first (operator 6).

A known word is scored by its log frequency in each language. A word that no language knows falls back to its
character n-grams, the longest first: the first length at which any of its n-grams is known gives the mean of their
log frequencies. A text's score per language is the sum over its words; the prediction is the largest.

Words are runs of letters and number signs that are not digits, lower-cased; a text needs one true letter. For n-grams of
two and more a word carries a mark at both ends. Whole texts are read.

Defined results: ``und`` and score 0 for a null text, a text without letters, and where no language was learned; ties
go to the language that sorts first. Rows with a null language or null id are not learned from; a null id is not held
out. The score is the softmax of the sums divided by the square root of the number of words, so it is between 0
and 1; it compares the learned languages with each other. Whether any of them fits is told by the share of a text's words that
the predicted language knows (``least_known``). Repeated rows get equal results, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.scale import percentiles
from crosswalk.llm.common import add_columns, keep_columns, map_batches, texts
from crosswalk.session import cut

WORD = re.compile(r"[^\W\d_]+")
LENGTHS = (5, 4, 3, 2, 1)
CACHE = 300_000  # words whose scores a task remembers before it starts anew


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies per language of words (length 0) and of n-grams of each length.

    ``tables[n]`` holds the entries and a row of figures for each. Looked-up words are remembered per task as rows of
    one array; unseen words are forgotten when there are ``CACHE`` of them.
    """

    def __init__(self, languages: list[str], tables: dict[int, tuple[list[str], np.ndarray]], known: np.ndarray | None = None):
        """``known`` tells for each entry of the word table, by language, whether the language has it."""
        self.languages, self.tables = languages, tables
        self.known = known if known is not None else np.zeros((len(tables[0][0]) if tables else 0, len(languages)), dtype=bool)
        self._at = {n: dict(zip(names, range(len(names)))) for n, (names, _) in tables.items()}
        self._known = len(tables[0][0]) if tables else 0
        self._forget()

    def __reduce__(self):
        packed = {n: ("\n".join(names), table) for n, (names, table) in self.tables.items()}
        return unpack, (self.languages, packed, self.known)

    def _forget(self) -> None:
        self._seen = dict(self._at.get(0, {}))
        self._rows = np.zeros((self._known + 1024, len(self.languages)))
        if self._known:
            self._rows[: self._known] = self.tables[0][1]

    def _learn(self, word: str) -> int:
        at = len(self._seen)
        if at == len(self._rows):
            self._rows = np.vstack([self._rows, np.zeros_like(self._rows)])
        self._rows[at] = self.unseen(word)
        self._seen[word] = at
        return at

    def unseen(self, word: str) -> np.ndarray:
        """Figures of a word that is not in the word table: the longest n-grams of which any is known."""
        for n in LENGTHS:
            known = self._at[n]
            rows = [known[g] for g in grams(word, n) if g in known]
            if rows:
                return self.tables[n][1][rows].mean(axis=0)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, and the share of words that the language knows; one more word counts as known, so that
        a text of few words is not judged by them alone."""
        words = Counter(WORD.findall(text.lower())) if text else Counter()
        if not self.languages or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0, 0.0
        if len(self._seen) > self._known + CACHE:
            self._forget()
        get = self._seen.get
        rows = np.array([at if (at := get(w)) is not None else self._learn(w) for w in words])
        counts = np.fromiter(words.values(), dtype=float, count=len(words))
        total = counts @ self._rows[rows]
        best = int(np.argmax(total))
        z = (total - total[best]) / np.sqrt(counts.sum())
        listed = rows < self._known
        n = counts[listed] @ self.known[rows[listed], best]
        return self.languages[best], float(1.0 / np.exp(z).sum()), float((n + 1) / (counts.sum() + 1))


def unpack(languages: list[str], packed: dict[int, tuple[str, np.ndarray]], known: np.ndarray) -> Model:
    return Model(languages, {n: (names.split("\n") if names else [], table) for n, (names, table) in packed.items()}, known)


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of the id as text leaves remainder 1 by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, per_language: int | None, learned: bool = True) -> DataFrame:
    """``lang``, ``text`` of the rows learned from, or else held out, with the smallest hashes: about ``per_language`` a
    language. None: all of them.

    The hash below which documents are taken follows from the number of a language's documents, which is all that is
    collected, one figure per language; texts are not read for it, and no rows are moved or ranked.
    """
    rows = texts(docs, F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (held_out(F.col("doc_id")) != F.lit(learned)))
    if per_language is None:
        return once(rows)
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n")).collect()
    if not sizes:
        return rows.select("lang", "text").limit(0)
    below = {r["lang"]: min((1 << 63) - 1, int(per_language / max(1, r["n"]) * (1 << 64)) - (1 << 63)) for r in sizes}
    most = F.create_map(*[F.lit(v) for pair in below.items() for v in pair])
    return once(rows.filter(F.col("h") <= most[F.col("lang")]))


def once(rows: DataFrame) -> DataFrame:
    """``lang``, ``text`` of each document once."""
    return rows.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("lang", "text")


def count_entries(rows: DataFrame) -> DataFrame:
    """(``lang``, ``n``, ``entry``, ``c``): counts of words (n = 0) and of n-grams of each length."""

    def run(batch):
        found: Counter = Counter()
        columns = batch.to_pydict()
        words: dict[str, Counter] = {}
        for lang, text in zip(columns["lang"], columns["text"]):
            words.setdefault(lang, Counter()).update(WORD.findall((text or "").lower()))
        for lang, counts in words.items():
            for w, c in counts.items():
                found[lang, 0, w] += c
                for n in LENGTHS:
                    for g in grams(w, n):
                        found[lang, n, g] += c
        keys = list(found)
        return {"lang": [k[0] for k in keys], "n": [k[1] for k in keys], "entry": [k[2] for k in keys], "c": list(found.values())}

    counts = map_batches(rows, run, "lang string, n int, entry string, c long")
    return counts.groupBy("lang", "n", "entry").agg(F.sum("c").alias("c"))


def fit(docs: DataFrame, per_language: int = 1500, floor: float = 1e-5, alpha: float = 0.5) -> Model:
    """Learn from a bounded sample of about ``per_language`` documents of each language.

    A word, or an n-gram of a length, is an entry of a language if it makes up a share of ``floor`` or more of the language's words or n-grams of that
    length. What is rarer counts as unseen. So a language has 1 / ``floor`` entries of a length at most, whatever
    the texts are.
    """
    found = cut(count_entries(training_rows(docs, per_language)), "language-counts")
    sizes = found.groupBy("lang", "n").agg(F.ceil(F.sum("c") * F.lit(floor)).alias("fewest"))
    top = found.join(F.broadcast(sizes), ["lang", "n"]).filter(F.col("c") >= F.col("fewest")).drop("fewest").toPandas()  # six rows a language
    languages = sorted(top["lang"].unique().tolist())
    at = {lang: i for i, lang in enumerate(languages)}
    tables, known = {}, None
    for n in (0, *LENGTHS):
        part = top[top["n"] == n]
        names = sorted(set(part["entry"]))
        row = {e: i for i, e in enumerate(names)}
        counts = np.zeros((len(names), len(at)))
        counts[part["entry"].map(row).to_numpy(dtype=int), part["lang"].map(at).to_numpy(dtype=int)] = part["c"].to_numpy(dtype=float)
        known = counts > 0 if n == 0 else known
        tables[n] = names, np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * max(1, len(names)))
    return Model(languages, tables, known)


def least_known(docs: DataFrame, model: Model, enough: int = 20) -> dict[str | None, float]:
    """The share of known words below which a text does not fit its predicted language: half the 5th percentile among
    all held-out texts of the language that are identified as such.

    It does not depend on the number of languages. A language with fewer than ``enough`` such texts is judged by the
    figure of all languages together, which is the entry None; without any such text there is none and all texts fit.
    """

    def run(batch):
        found = [(lang, model.judge(t)) for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist())]
        right = [(f[0], f[2]) for lang, f in found if f[0] == lang]
        return {"lang": [r[0] for r in right], "share": [r[1] for r in right]}

    shares = cut(map_batches(training_rows(docs, None, learned=False), run, "lang string, share double"), "known-shares")
    counts = {r["lang"]: r["n"] for r in shares.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    own = percentiles(shares, ["lang"], "share", {"low": 0.05}).collect()
    every = percentiles(shares.withColumn("every", F.lit(True)), ["every"], "share", {"low": 0.05}).collect()
    return {r["lang"]: r["low"] / 2 for r in own if counts[r["lang"]] >= enough} | {None: r["low"] / 2 for r in every}


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = (), least: Mapping[str | None, float] | None = None) -> DataFrame:
    """``doc_id``, the columns in ``keep``, ``held_out``, ``lang_pred`` and ``score`` of every row; with ``least`` (see
    ``least_known``) also ``fits``, whether the text has the share of known words that its language asks for."""

    def run(batch):
        found = [model.judge(t) for t in batch.column("text").to_pylist()]
        out = {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
        return out if least is None else out | {"fits": [f[0] != "und" and f[2] >= least.get(f[0], least.get(None, 0.0)) for f in found]}

    new = ["lang_pred", "score"] + ([] if least is None else ["fits"])
    out = add_columns(texts(docs, *keep_columns(docs, keep)), run, "lang_pred string, score double" + ("" if least is None else ", fits boolean"))
    rest = [c for c in out.columns if c in keep and c not in ("doc_id", "held_out", *new)]
    return out.select("doc_id", *rest, held_out(F.col("doc_id")).alias("held_out"), *new)
