"""Quality by labelling lines as content or boilerplate (operator 2).

A linear-chain conditional random field with two states runs over the lines of a text that hold a word. Emissions look
at a line's shape only (symbols, capitals, digits, repeated words, length, earlier equal lines), transitions at the
neighbours. Viterbi decoding marks each line; the share of words on content lines decides whether a text is kept. A
few plain figures of the text form a base rule in front of it.

The field is fitted on a bounded sample of documents labelled good or bad. As lines have no labels, a logistic model of
the document's label is fitted first; lines of bad documents that it holds for good count as content, all other lines
take their document's label. Then the field's likelihood is climbed with forward-backward gradients.

Defined results: null, empty and wordless texts have figures 0, fail the base rule and are not kept. Without
labels of both classes every line is content. Equal rows get equal results; ties in decoding go to content.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswalk.llm.common import add_columns, fit_logistic, keep_columns, map_batches, sample_ids, sample_texts, sigmoid, texts

SYMBOLS = b"#*$%&|<>"
UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
# Upper ends of the ranges of each line figure.
EDGES = {
    "symbols": [0.0, 0.1, 0.4, 0.9],
    "exclamations": [0.0, 0.2, 0.6],
    "capitals": [0.05, 0.15, 0.4, 0.8],
    "digits": [0.0, 0.1, 0.3],
    "variety": [0.2, 0.5, 0.8, 0.95],
    "words": [1, 2, 4, 8, 16, 40],
    "repeated": [0.5],
}
WIDTH = sum(len(e) + 1 for e in EDGES.values())


def count_of(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def window_repeats(words: Sequence[bytes], size: int = 5) -> int:
    """How many words lie in a window of ``size`` words that is found twice or more; windows are compared exactly."""
    if len(words) <= size:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    keys, base = ids, len(number)
    for k in range(1, size):  # after each step a key stands for k + 1 words; it is renumbered to stay exact
        keys = keys[:-1] * base + ids[k:]
        if k < size - 1 and base ** (k + 2) >= 1 << 62:
            keys = np.unique(keys, return_inverse=True)[1].astype(np.int64)
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


@dataclass
class Figures:
    """Base figures of one text, and per line with a word its word count and shape."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_words: list[int]
    shapes: list[tuple]


def figures(text: str | None) -> Figures:
    data = (text or "").encode("utf-8", "surrogatepass")
    words: list[bytes] = []
    seen: set[bytes] = set()
    line_words, shapes, dup = [], [], 0
    for line in data.split(b"\n"):
        own = line.split()
        if not own:
            continue
        n = len(own)
        repeated = line in seen
        seen.add(line)
        dup += repeated
        upper = count_of(line, UPPER)
        letters = upper + count_of(line, LOWER)
        shapes.append((count_of(line, SYMBOLS) / n, line.count(b"!") / n, upper / max(1, letters), count_of(line, DIGITS) / len(line), len(set(own)) / n, n, repeated))
        line_words.append(n)
        words += own
    blanks = sum(data.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    return Figures(len(words), len(text or "") - blanks, count_of(data, SYMBOLS), dup, window_repeats(words), line_words, shapes)


def bins(shapes: Sequence[tuple]) -> np.ndarray:
    """For each line the numbers of its indicator features, one per figure."""
    values = np.array(shapes, dtype=float).reshape(-1, len(EDGES))
    start, out = 0, np.empty(values.shape, dtype=np.int64)
    for k, edges in enumerate(EDGES.values()):
        out[:, k] = start + np.searchsorted(edges, values[:, k], side="left")
        start += len(edges) + 1
    return out


class Lines:
    """Lines of many texts, dealt by position: slice t holds line t of every text that has one, longest texts first."""

    def __init__(self, lengths: Sequence[int]):
        lengths = np.asarray(lengths, dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        steps = int(lengths.max(initial=0))
        ended = np.bincount(lengths, minlength=steps + 1)
        active = len(lengths) - np.cumsum(ended)[:steps]
        start = np.concatenate([[0], np.cumsum(lengths)])[:-1][self.order]
        self.slices, at, place = [], 0, []
        for t in range(steps):
            k = int(active[t])
            self.slices.append(slice(at, at + k))
            place.append(start[:k] + t)
            at += k
        self.place = np.concatenate(place) if place else np.zeros(0, dtype=np.int64)


@dataclass
class Field:
    """Score of state 1 (content) per indicator, of each transition and of starting in state 1."""

    emit: np.ndarray
    move: np.ndarray
    start: float

    def viterbi(self, shapes: Sequence[tuple], lengths: Sequence[int]) -> np.ndarray:
        """True for each line decoded as content; ``shapes`` holds the lines of texts with ``lengths`` in order."""
        lines = Lines(lengths)
        e = self.emit[bins(shapes)].sum(axis=1)[lines.place]
        back = np.zeros((2, len(e)), dtype=bool)
        state = np.zeros(len(e), dtype=bool)
        best = np.zeros((2, 0))
        ends: list[np.ndarray] = []
        for t, s in enumerate(lines.slices):
            k = s.stop - s.start
            if t == 0:
                best = np.vstack([np.zeros(k), self.start + e[s]])
            else:
                ends.append(best[:, k:])
                best = best[:, :k]
                new = []
                for to in (0, 1):
                    stay, come = best[0] + self.move[0, to], best[1] + self.move[1, to]
                    back[to, s] = come >= stay
                    new.append(np.maximum(stay, come) + (e[s] if to else 0.0))
                best = np.vstack(new)
        ends.append(best)
        follow = np.zeros(0, dtype=bool)
        for t in range(len(lines.slices) - 1, -1, -1):
            s = lines.slices[t]
            last = ends[t]
            own = last[1] >= last[0]
            state[s] = np.concatenate([follow, own])
            follow = np.where(state[s], back[1, s], back[0, s]) if t else follow
        out = np.zeros(len(e), dtype=bool)
        out[lines.place] = state
        return out


def fit_field(shapes: Sequence[tuple], lengths: Sequence[int], good: Sequence[int], steps: int = 150, l2: float = 1e-3) -> Field:
    """Fit the field on lines whose texts are labelled ``good`` (1) or bad (0)."""
    field = Field(np.zeros(WIDTH), np.zeros((2, 2)), 0.0)
    doc = np.repeat(np.asarray(good, dtype=float), np.asarray(lengths, dtype=np.int64))
    if not len(doc) or doc.min() == doc.max():
        return field
    at = bins(shapes)
    x = np.zeros((len(at), WIDTH))
    np.put_along_axis(x, at, 1.0, axis=1)
    # Logistic model of the document's label on distinct line shapes, weighted by how often they occur.
    weights = fit_logistic(x, doc, 1e-4, 120)
    y = np.where(doc > 0, 1.0, (sigmoid(x @ weights[:-1] + weights[-1]) > 0.5).astype(float))
    lines = Lines(lengths)
    x, y = x[lines.place], y[lines.place]
    n = len(y)
    seen_emit = x.T @ y
    seen_move, seen_start = np.zeros((2, 2)), y[lines.slices[0]].sum()
    for a, b in zip(lines.slices, lines.slices[1:]):
        k = b.stop - b.start
        np.add.at(seen_move, (y[a][:k].astype(int), y[b].astype(int)), 1)
    theta = np.zeros(WIDTH + 5)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emit, move, start = theta[:WIDTH], theta[WIDTH:-1].reshape(2, 2), theta[-1]
        p, pairs, first = marginals(np.clip(x @ emit, -30, 30), move, start, lines)
        grad = np.concatenate([seen_emit - x.T @ p, (seen_move - pairs).ravel(), [seen_start - first]]) / n - l2 * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:WIDTH], theta[WIDTH:-1].reshape(2, 2), float(theta[-1]))


def marginals(e: np.ndarray, move: np.ndarray, start: float, lines: Lines) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of state 1 per line, expected transition counts and expected starts in state 1."""
    m, w = np.exp(move), np.vstack([np.ones_like(e), np.exp(e)])
    forward, p, pairs = np.empty((2, len(e))), np.empty(len(e)), np.zeros((2, 2))
    for t, s in enumerate(lines.slices):
        k = s.stop - s.start
        if t == 0:
            f = np.array([[1.0], [np.exp(start)]]) * w[:, s]
        else:
            f = (m.T @ forward[:, lines.slices[t - 1]][:, :k]) * w[:, s]
        forward[:, s] = f / f.sum(axis=0)
    backward = np.ones((2, 0))
    for t in range(len(lines.slices) - 1, -1, -1):
        s = lines.slices[t]
        k = s.stop - s.start
        backward = np.hstack([backward, np.ones((2, k - backward.shape[1]))])
        both = forward[:, s] * backward
        p[s] = both[1] / both.sum(axis=0)
        if t:
            ahead = w[:, s] * backward
            joint = forward[:, lines.slices[t - 1]][:, :k][:, None, :] * m[:, :, None] * ahead[None, :, :]
            pairs += (joint / joint.sum(axis=(0, 1))).sum(axis=2)
            backward = m @ ahead
            backward /= backward.sum(axis=0)
    return p, pairs, float(p[lines.slices[0]].sum())


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1024) -> Field:
    """Fit on at most ``per_class`` labelled documents of each class. Line figures are taken in all tasks; the
    likelihood of the bounded sample is climbed in one."""
    sample = sample_texts(docs, sample_ids(labels, label, per_class), "line-sample")

    def shape(batch):
        found = [figures(t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "good": batch.column(label), "shapes": [[list(map(float, s)) for s in f.shapes] for f in found]}

    rows = map_batches(sample.select("doc_id", "text", label), shape, "doc_id long, good int, shapes array<array<double>>")

    def climb(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        shapes = [tuple(s) for d in group["shapes"] for s in d]
        field = fit_field(shapes, [len(d) for d in group["shapes"]], group["good"].tolist())
        return pd.DataFrame({"emit": [field.emit.tolist()], "move": [field.move.ravel().tolist()], "start": [field.start]})

    got = rows.groupBy(F.lit(0).alias("one")).applyInPandas(climb, "emit array<double>, move array<double>, start double").collect()
    if not got:
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), 0.0)
    return Field(np.array(got[0]["emit"]), np.array(got[0]["move"]).reshape(2, 2), got[0]["start"])


def judge(docs: DataFrame, field: Field, min_share: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns in ``keep``, the base figures, ``base_failed``, ``content_words`` and ``kept``.

    The base rule fails a text of fewer than 10 words, or with over a fifth of its words in repeated windows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batch):
        found = [figures(t) for t in batch.column("text").to_pylist()]
        content = field.viterbi([s for f in found for s in f.shapes], [len(f.shapes) for f in found])
        words = np.array([w for f in found for w in f.line_words], dtype=np.int64) * content
        total = np.concatenate([[0], np.cumsum(words)])
        ends = np.cumsum([len(f.shapes) for f in found])
        out = {n: [getattr(f, n) for f in found] for n in names}
        out["content_words"] = (total[ends] - total[ends - [len(f.shapes) for f in found]]).tolist() if found else []
        out["base_failed"] = [f.n_words < 10 or 100 * f.n_repeat_words > 20 * f.n_words for f in found]
        out["kept"] = [not b and c >= min_share * f.n_words for b, c, f in zip(out["base_failed"], out["content_words"], found)]
        return out

    schema = ", ".join(f"{n} long" for n in (*names, "content_words")) + ", base_failed boolean, kept boolean"
    out = add_columns(texts(docs, *keep_columns(docs, keep)), run, schema)
    new = [*names, "base_failed", "kept", "content_words"]
    rest = [c for c in out.columns if c in keep and c not in ("doc_id", *new)]
    return out.select("doc_id", *rest, *new)
