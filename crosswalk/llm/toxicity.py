"""Toxicity by a classifier chain (operator 1).

Categories are predicted one after another. The linear model of each category sees the word features and the
probabilities of all earlier categories; while training, these are out-of-fold predictions, so a later model learns
from earlier probabilities as good as it will meet them on new text.

The categories come from the labels. Where labels tell one kind of toxicity from another, their words can be given; otherwise the
telling words of the sample are put into groups by the documents they occur in together, and each group is a category
that comes before the label itself.

Features are words and their first letters (4 and 5), since a stem may be all that a group of words shares. Those are
chosen whose chi-squared figure on a bounded sample of labelled documents is above what chance gives; the value of a
feature is log(1 + count). Words are runs of letters, lower-cased; whole texts are read, also very long ones.

Defined results: a null or empty text, or one without letters, has no features and gets the probabilities of an empty
text, but is never rejected. Repeated rows get equal results. Without labelled rows of both classes a category has
a constant probability near the only class seen (0.001 where none is). An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswalk.llm.common import add_columns, fit_logistic, keep_columns, map_batches, sample_ids, sample_texts, sigmoid, texts

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
CACHE = 400_000  # words whose features a task remembers before it starts anew


def word_features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) >= n]]


def word_counts(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


@dataclass
class Chain:
    """Feature names, and for each category in order its weights: features, earlier categories, intercept."""

    categories: list[str]
    features: list[str]
    weights: list[list[float]]

    def __post_init__(self):
        self._at = {f: i for i, f in enumerate(self.features)}
        self._seen: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {"categories": self.categories, "features": self.features, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def values(self, text: str | None) -> dict[int, float]:
        """Feature values of a text, by feature number."""
        counts: Counter = Counter()
        seen = self._seen
        for word, n in word_counts(text).items():
            known = seen.get(word)
            if known is None:
                if len(seen) > CACHE:
                    seen.clear()
                known = seen[word] = tuple(self._at[f] for f in word_features(word) if f in self._at)
            for i in known:
                counts[i] += n
        return {i: float(np.log1p(n)) for i, n in counts.items()}

    def predict(self, values: Mapping[int, float]) -> list[float]:
        out: list[float] = []
        for weights in self.weights:
            z = weights[-1] + sum(weights[i] * v for i, v in values.items())
            z += sum(w * p for w, p in zip(weights[len(self.features) : -1], out))
            out.append(float(sigmoid(np.float64(z))))
        return out


def count_features(sample: DataFrame, label: str) -> DataFrame:
    """(``feature``, ``n1``, ``n0``): in how many sampled documents of either class a feature occurs."""

    def run(batch):
        found: dict[str, list[int]] = {}
        columns = batch.to_pydict()
        for text, y in zip(columns["text"], columns[label]):
            present = {f for w in word_counts(text) for f in word_features(w)}
            for f in present:
                found.setdefault(f, [0, 0])[1 - y] += 1
        return {"feature": list(found), "n1": [v[0] for v in found.values()], "n0": [v[1] for v in found.values()]}

    counts = map_batches(sample.select("text", label), run, "feature string, n1 long, n0 long")
    return counts.groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def choose_features(sample: DataFrame, label: str, min_docs: int, min_chi: float) -> list[str]:
    """The features that are more frequent in class 1, by falling chi-squared figure.

    ``min_chi`` keeps out what is more frequent by chance only, as many thousands of features are looked at, and what a
    group of near copies has in common. The sample bounds what can pass it.
    """
    size = {r[label]: r["n"] for r in sample.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    t, c = float(size.get(1, 0)), float(size.get(0, 0))
    if not t or not c:
        return []
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    chi = (t + c) * F.pow(a * F.lit(c) - b * F.lit(t), 2) / ((a + b) * (F.lit(t + c) - a - b + 1e-9) * F.lit(t * c))
    top = (
        count_features(sample, label)
        .filter((F.col("n1") >= min_docs) & (a * F.lit(c) > b * F.lit(t)) & (chi >= min_chi))
        .orderBy(chi.desc(), "feature")
    )
    return [r["feature"] for r in top.collect()]


def word_kinds(present: np.ndarray, words: Sequence[int], kinds: int) -> list[list[int]]:
    """The features in ``words`` in ``kinds`` groups; ``present`` says which features each document of class 1 has.

    The first group grows around the most frequent word, each further one around the word that shares the fewest documents with the
    words before; every other word joins the group with which it shares the largest part of its documents. With fewer words than groups the
    last ones are empty.
    """
    if not len(words):
        return [[] for _ in range(kinds)]
    have = present[:, list(words)].astype(float)
    size = have.sum(axis=0)
    alike = (have.T @ have) / np.sqrt(np.outer(size, size) + 1e-9)
    seeds = [int(size.argmax())]
    while len(seeds) < min(kinds, len(words)):
        apart = alike[:, seeds].max(axis=1) - 1e-6 * size / (size.max() + 1e-9)
        apart[seeds] = np.inf
        seeds.append(int(apart.argmin()))
    near = alike[:, seeds].argmax(axis=1)
    near[seeds] = range(len(seeds))
    return [[words[i] for i in np.flatnonzero(near == k)] for k in range(kinds)]


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    markers: Mapping[str, Sequence[str]] | None = None,
    kinds: int = 2,
    label: str = "toxic",
    per_class: int = 4096,
    min_docs: int = 4,
    min_chi: float = 60.0,
    folds: int = 3,
    l2: float = 1e-4,
    steps: int = 250,
) -> Chain:
    """Fit a chain on at most ``per_class`` labelled documents of each class of ``label``.

    The chain's categories are the keys of ``markers`` in order, or else ``kinds`` groups of words found in the sample (``kind_1``
    and so on), then ``label`` itself. A document belongs to an earlier category if it is labelled 1 and holds one of the
    category's words. The sample is bounded, so the last step, the fit, runs in one task; choosing features and reading texts is spread
    over all tasks.
    """
    sample = sample_texts(docs, sample_ids(labels, label, per_class), "toxicity-sample")
    features = choose_features(sample, label, min_docs, min_chi)
    words = {k: frozenset(v) for k, v in (markers or {}).items()}
    categories = [*(words if markers is not None else [f"kind_{k + 1}" for k in range(kinds)]), label]
    whole = [i for i, f in enumerate(features) if not f.endswith("*")]
    blank = Chain(categories, features, [])

    def featurise(batch):
        columns = batch.to_pydict()
        out: dict[str, list] = {"doc_id": columns["doc_id"], "at": [], "value": [], "y": []}
        for text, y in zip(columns["text"], columns[label]):
            values = blank.values(text)
            present = word_counts(text).keys()
            out["at"].append(list(values))
            out["value"].append(list(values.values()))
            out["y"].append([int(y and not words[k].isdisjoint(present)) for k in words] + [y])
        return out

    rows = map_batches(sample.select("doc_id", "text", label), featurise, "doc_id long, at array<int>, value array<double>, y array<int>")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        x = np.zeros((len(group), len(features)))
        for i, (at, value) in enumerate(zip(group["at"], group["value"])):
            x[i, np.asarray(at, dtype=int)] = value
        y = np.array(group["y"].tolist(), dtype=float).reshape(len(group), len(words) + 1)
        if markers is None:
            toxic = y[:, -1] > 0
            found = [toxic & (x[:, g] > 0).any(axis=1) for g in word_kinds(x[toxic] > 0, whole, kinds)]
            y = np.column_stack([*found, y[:, -1]]).astype(float)
        fold = np.arange(len(group)) % folds
        weights = []
        for k in range(len(categories)):
            weights.append(fit_logistic(x, y[:, k], l2, steps).tolist())
            if k < len(categories) - 1:
                out_of_fold = np.zeros(len(group))
                for f in range(folds):
                    w = fit_logistic(x[fold != f], y[fold != f, k], l2, steps)
                    out_of_fold[fold == f] = sigmoid(x[fold == f] @ w[:-1] + w[-1])
                x = np.hstack([x, out_of_fold[:, None]])
        return pd.DataFrame({"weights": [json.dumps(weights)]})

    fitted = rows.groupBy(F.lit(0).alias("one")).applyInPandas(fit, "weights string").collect()
    no_rows = [[0.0] * (len(features) + k) + [-6.9] for k in range(len(categories))]
    return Chain(categories, features, json.loads(fitted[0]["weights"]) if fitted else no_rows)


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns in ``keep``, a probability ``p_<category>`` each, and ``toxic``: whether the last
    category's probability reaches ``threshold``. A text without words is not toxic."""
    names = [f"p_{c}" for c in chain.categories]

    def run(batch):
        out: dict[str, list] = {n: [] for n in names} | {"toxic": []}
        for text in batch.column("text").to_pylist():
            p = chain.predict(chain.values(text))
            for n, v in zip(names, p):
                out[n].append(v)
            out["toxic"].append(bool(p[-1] >= threshold and text and WORD.search(text)))
        return out

    schema = ", ".join([f"`{n}` double" for n in names] + ["toxic boolean"])
    out = add_columns(texts(docs, *keep_columns(docs, keep)), run, schema)
    rest = [c for c in out.columns if c in keep and c not in ("doc_id", "toxic", *names)]
    return out.select("doc_id", *rest, *names, "toxic")
