import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crosswalk.llm import language, line_quality, queries, toxicity
from crosswalk.llm.common import fit_logistic, sigmoid


@pytest.fixture(scope="module")
def folder(data_dir):
    return data_dir.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def tables(spark, folder):
    return [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


def test_line_query_base_figures_equal_plain_python(spark, folder, tables):
    docs, labels = tables
    got = {r.doc_id: r for r in queries.QUERIES["op2_line_labels"](spark, folder).collect()}
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == plain_base(r.text)
        assert not (g.kept and g.base_failed)
    good = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(good[i], g.kept) for i, g in got.items() if i in good and not g.base_failed]
    assert np.mean([bool(q) == k for q, k in judged]) > 0.97
    assert all(k for q, k in judged if q)


def test_line_figures_of_odd_rows(odd_docs, no_docs, no_labels):
    field = line_quality.fit(odd_docs, no_labels)
    rows = line_quality.judge(odd_docs, field).collect()
    want = Counter((r.doc_id, *plain_base(r.text)) for r in odd_docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want
    assert all(r.kept == (not r.base_failed) and r.content_words == r.n_words for r in rows)
    assert line_quality.judge(no_docs, field).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_repeated_windows_are_exact(seed):
    rnd = np.random.default_rng(seed)
    for n in (0, 4, 5, 6, 40, 3000):
        words = [b"%d" % x for x in rnd.integers(0, [2, 30, 3000, 10**6][seed], n)]
        words += words[:20]
        assert line_quality.window_repeats(words) == plain_base(b" ".join(words).decode())[4]


def test_decoding_and_gradients_equal_enumeration():
    """Viterbi and marginals against all labellings of short texts."""
    rnd = np.random.default_rng(1)
    lengths = [3, 1, 0, 5, 2]
    shapes = [tuple(rnd.choice([0.0, 0.3, 0.7, 1.0, 5.0], 7)) for _ in range(sum(lengths))]
    field = line_quality.Field(rnd.normal(size=line_quality.WIDTH), rnd.normal(size=(2, 2)), 0.4)
    e = field.emit[line_quality.bins(shapes)].sum(axis=1)
    got, at = field.viterbi(shapes, lengths), 0
    lines = line_quality.Lines(lengths)
    p, pairs, first = line_quality.marginals(e[lines.place], field.move, field.start, lines)
    p_line = np.empty(len(p))
    p_line[lines.place] = p
    all_pairs, all_first = np.zeros((2, 2)), 0.0
    for n in lengths:
        scores = {}
        for code in range(2**n):
            y = [code >> k & 1 for k in range(n)]
            scores[tuple(y)] = sum(e[at + k] for k in range(n) if y[k]) + (field.start * y[0] if n else 0) + sum(field.move[a, b] for a, b in zip(y, y[1:]))
        assert tuple(got[at : at + n].astype(int)) == max(scores, key=scores.get)
        total = sum(np.exp(list(scores.values())))
        for y, s in scores.items():
            share = np.exp(s) / total
            for a, b in zip(y, y[1:]):
                all_pairs[a, b] += share
            all_first += share * y[0] if n else 0
        for k in range(n):
            assert np.isclose(p_line[at + k], sum(np.exp(s) for y, s in scores.items() if y[k]) / total)
        at += n
    assert np.allclose(pairs, all_pairs) and np.isclose(first, all_first)


def test_chain_on_held_out_labels(spark, tables):
    docs, labels = tables
    learned, held = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    chain = toxicity.fit_chain(docs, learned)
    assert chain.categories == ["kind_1", "kind_2", "toxic"] and [len(w) for w in chain.weights] == [len(chain.features) + k + 1 for k in range(3)]
    # Few rows are labelled here in other languages, so only the one with enough is judged.
    truth = held.select("doc_id", F.col("toxic").alias("label")).join(docs.filter("lang = 'en'").select("doc_id"), "doc_id")
    rows = toxicity.score(docs, chain).join(truth, "doc_id").collect()
    assert len(rows) > 40 and sum(r.label for r in rows) > 4
    assert np.mean([r.toxic == bool(r.label) for r in rows]) >= 0.95


def test_chain_scores_equal_plain_python_and_odd_rows(spark, odd_docs, no_docs, no_labels, tables):
    docs, labels = tables
    chain = toxicity.fit_chain(docs, labels)
    for r in toxicity.score(odd_docs, chain, keep=["kept", "text"]).collect():
        counts = Counter(w for w in re.findall(r"[^\W\d_]+", (r.text or "").lower()))
        z = {i: np.log1p(sum(n for w, n in counts.items() if f in toxicity.word_features(w))) for i, f in enumerate(chain.features)}
        p = []
        for w in chain.weights:
            p.append(sigmoid(np.float64(w[-1] + sum(w[i] * v for i, v in z.items()) + sum(a * b for a, b in zip(w[len(chain.features) : -1], p)))))
        assert np.allclose([r.p_kind_1, r.p_kind_2, r.p_toxic], p)
        assert r.kept == "x" and r.toxic == bool(counts and p[-1] >= 0.5)
    assert toxicity.score(no_docs, chain).count() == 0
    blank = toxicity.fit_chain(odd_docs, no_labels)
    assert not toxicity.score(odd_docs, blank).filter("toxic").count() and blank.features == []


def test_logistic_separates_and_constant_classes():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(400, 3))
    y = (x @ [2.0, -1.0, 0.0] + 0.5 > 0).astype(float)
    w = fit_logistic(x, y, 1e-4, 300)
    assert ((sigmoid(x @ w[:-1] + w[-1]) > 0.5) == y).mean() > 0.97
    assert sigmoid(fit_logistic(x, np.zeros(400), 1e-4, 5)[-1]) < 0.01 < 0.99 < sigmoid(fit_logistic(x, np.ones(400), 1e-4, 5)[-1])


def test_language_query_on_held_out_rows(spark, folder, tables):
    docs, _ = tables
    got = queries.QUERIES["op6_word_first_language"](spark, folder)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert np.mean(held) >= 0.98 and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in docs.filter("crc32(cast(doc_id as string)) % 3 = 1").collect()}


def test_language_backs_off_to_shorter_grams(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat", "en") for i in range(30)] + [(100 + i, "der hund lief über die wiese", "de") for i in range(30)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    seen, unseen = model.predict("the mat"), model.predict("wiesenhund")
    assert seen[0] == "en" and unseen[0] == "de"
    table = model.tables[5]
    known = [g for g in language.grams("wiesenhund", 5) if g in set(table[0])]
    assert known and np.allclose(model.unseen("wiesenhund"), np.mean([table[1][table[0].index(g)] for g in known], axis=0))
    assert np.allclose(model.unseen("qqq"), 0) and model.predict("12 34") == model.predict("\u00b2 \u00bd") == model.predict(None) == model.predict("") == ("und", 0.0)


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = language.fit(odd_docs)
    got = language.identify(odd_docs, model, keep=["text", "lang", "score"])
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    empty = language.fit(no_docs)
    assert language.identify(no_docs, model).count() == 0
    assert {r.lang_pred for r in language.identify(odd_docs, empty).collect()} == {"und"}
    assert got.filter(F.col("score") > 1).count() == 0


def test_kinds_of_toxicity_come_from_the_labels(spark):
    """Two kinds with words of their own, which no list in the code has, in other words' company."""
    rnd = np.random.default_rng(2)
    plain_words = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "mo", "ne") for b in ("ra", "sti", "tuk", "ven", "zol")]
    first, second = ["grumsh", "vokta", "zarn"], ["pelk", "quib", "thrun"]
    rows, labels = [], []
    for i in range(900):
        kind = [0, 0, 1, 2][i % 4]
        words = list(rnd.choice(plain_words, 30)) + list(rnd.choice([[], first, second][kind], 2 if kind else 0))
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind > 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chain = toxicity.fit_chain(docs, spark.createDataFrame(labels[:600], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    for i in range(600, 900):
        kind, g = [0, 0, 1, 2][i % 4], got[i]
        assert g.toxic == bool(kind)
        assert (max(g.p_kind_1, g.p_kind_2) > 0.5) == bool(kind)
    held = [got[i] for i in range(600, 900)]
    split = {kind: {g.p_kind_1 > g.p_kind_2 for i, g in zip(range(600, 900), held) if [0, 0, 1, 2][i % 4] == kind} for kind in (1, 2)}
    assert len(split[1]) == len(split[2]) == 1 and split[1] != split[2]


def test_given_words_are_categories(spark, tables):
    docs, labels = tables
    chain = toxicity.fit_chain(docs, labels, {"a": ["idiot"], "b": ["no such word"]})
    assert chain.categories == ["a", "b", "toxic"]


def plain_language(rows, per_language, floor=1e-5, alpha=0.5):
    """(doc_id, prediction, score) from the definition, without tables of entries."""
    learn = {}
    for i, text, lang, hashed, below in rows:
        if lang is not None and i is not None and zlib.crc32(str(i).encode()) % 3 != 1 and hashed <= below[lang]:
            learn[lang, i] = min(text, learn.get((lang, i), text), key=lambda t: (t is None, t))
    words = {}
    for (lang, _), text in learn.items():
        words.setdefault(lang, Counter()).update(re.findall(r"[^\W\d_]+", (text or "").lower()))
    languages = sorted(k for k, v in words.items() if v)
    entries = {}
    for n in (0, 5, 4, 3, 2, 1):
        for lang in languages:
            c = Counter()
            for w, k in words[lang].items():
                marked = w if n < 2 else f"<{w}>"
                for g in [w] if n == 0 else [marked[j : j + n] for j in range(len(marked) - n + 1)]:
                    c[g] += k
            fewest = math.ceil(sum(c.values()) * floor)
            entries[n, lang] = {g: k for g, k in c.items() if k >= fewest}
    size = {n: len({g for lang in languages for g in entries[n, lang]}) for n in (0, 5, 4, 3, 2, 1)}
    total = {key: sum(c.values()) for key, c in entries.items()}

    def figure(n, lang, g):
        return math.log(entries[n, lang].get(g, 0) + alpha) - math.log(total[n, lang] + alpha * max(1, size[n]))

    def scores(word):
        for n in (0, 5, 4, 3, 2, 1):
            marked = word if n < 2 else f"<{word}>"
            grams = [word] if n == 0 else [marked[j : j + n] for j in range(len(marked) - n + 1)]
            known = [g for g in grams if any(g in entries[n, lang] for lang in languages)]
            if known:
                return [sum(figure(n, lang, g) for g in known) / len(known) for lang in languages]
        return [0.0] * len(languages)

    out = {}
    for i, text, *_ in rows:
        found = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not languages or not any(c.isalpha() for w in found for c in w):
            out[i] = ("und", 0.0)
            continue
        sums = [sum(s) for s in zip(*[scores(w) for w in found])]
        best = max(range(len(sums)), key=lambda k: sums[k])
        out[i] = (languages[best], 1 / sum(math.exp((s - sums[best]) / math.sqrt(len(found))) for s in sums))
    return out


def test_language_query_equals_plain_python(spark, data_dir):
    """The whole query: which documents are learned from, counts, floors, back-off, prediction and score."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    known = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~language.held_out(F.col("doc_id")))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n")).collect()}
    below = {lang: min((1 << 63) - 1, int(1500 / n * (1 << 64)) - (1 << 63)) for lang, n in sizes.items()}
    rows = [(*r, below) for r in docs.select("doc_id", "text", "lang", F.xxhash64(F.col("doc_id").cast("long"))).collect()]
    want = plain_language(rows, 1500)
    got = queries.QUERIES["op6_word_first_language"](spark, data_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.lang_pred == want[r.doc_id][0] and np.isclose(r.score, want[r.doc_id][1], atol=1e-9)


def test_learned_documents_are_about_as_many_as_asked_for(spark):
    rows = [(i, f"text {i}", "a" if i % 10 else "b") for i in range(20_000)] + [(7, "text 7", "a")] * 5000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    n = Counter(r.lang for r in language.training_rows(docs, 500).collect())
    assert 400 <= n["a"] <= 600 and 400 <= n["b"] <= 600
    assert language.training_rows(docs, 10**6).count() == docs.select("doc_id").distinct().filter(~language.held_out(F.col("doc_id"))).count()


def test_languages_with_few_held_out_texts_are_judged_by_all(spark):
    rows = [(i, "alpha beta gamma delta words of a kind here again", "en") for i in range(400)] + [(1000 + i, "uno dos tres cuatro cinco", "es") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    least = language.least_known(docs, model)
    assert set(least) == {"en", None} and least[None] > 0.3
    noise = spark.createDataFrame([(1, "uno qqq www eee rrr ttt yyy uuu iii ooo", None), (2, "uno dos tres", None)], docs.schema)
    assert {r.doc_id: r.fits for r in language.identify(noise, model, least=least).collect()} == {1: False, 2: True}


def test_least_share_of_known_words_comes_from_all_held_out_texts(spark):
    """1 in 8 of 4,000 texts has few known words: a figure of some hundred texts would not be the same."""
    known, odd = "alpha beta gamma delta words of a kind here again", "alpha beta gamma {0}q {0}w {0}e {0}r {0}t {0}y"
    rows = [(i, odd.format("z" * (1 + i % 7)) if i % 8 == 3 and zlib.crc32(str(i).encode()) % 3 == 1 else known + " again" * (i % 11), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    judged = [model.judge(t) for i, t, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    want = np.percentile([j[2] for j in judged if j[0] == "en"], 5) / 2
    calls = language.training_rows(docs, None, learned=False)
    assert calls.count() == len(judged)
    assert language.least_known(docs, model) == {"en": pytest.approx(want), None: pytest.approx(want)}
