import itertools
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from crosswalk.llm import queries, segment

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return segment.Pieces(PATH, 1.0)


def all_paths(text, pieces):
    """Every segmentation of a text with its probability, from the vocabulary alone."""
    s = segment.MARK + text.replace(" ", segment.MARK) if text else ""

    def below(i):
        if i == len(s):
            return [((), 1.0)]
        out, single = [], False
        for j in range(i + 1, len(s) + 1):
            pid, p = pieces.p.get(s[i:j], (-1, 0.0))
            if pid >= 0:
                single = single or j == i + 1
                out += [((pid, *rest), p * q) for rest, q in below(j)]
        if not single:
            data = s[i].encode()
            out += [((*(pieces.byte[b] for b in data), *rest), pieces.byte_p ** len(data) * q) for rest, q in below(i + 1)]
        return out

    found = below(0)
    total = sum(q for _, q in found)
    return {ids: q / total for ids, q in found}


def drawn(lattices, text, keys, k):
    return segment.draw(lattices, lattices.starts([text]) * len(keys), keys, k)


@pytest.mark.parametrize("text", ["the a", "Hi 𝔘!", "", "at in on"])
def test_draws_follow_sampling_without_replacement(pieces, text):
    lattices = segment.Lattices(pieces)
    want = all_paths(text, pieces)
    n = 4000
    keys = [segment.key_at(i, 3) for i in range(n)]
    first, second = Counter(), Counter()
    for found, threshold in drawn(lattices, text, keys, 2):
        ids = [tuple(lattices.piece[d.edges].tolist()) for d in found]
        assert len(set(ids)) == len(ids) == min(2, len(want))
        for i, d in zip(ids, found):
            assert math.isclose(math.exp(d.log_p.sum()), want[i], rel_tol=1e-6)
        values = [d.value for d in found]
        assert values == sorted(values, reverse=True) and threshold <= values[-1]
        first[ids[0]] += 1
        if len(ids) > 1:
            second[ids[1]] += 1
    then = Counter()
    for (a, p), (b, q) in itertools.permutations(want.items(), 2):
        then[b] += p * q / (1 - p)
    for got, expected in ((first, want), (second, then)):
        for ids, p in expected.items():
            assert abs(got[ids] / n - p) < 4.5 * math.sqrt(p * (1 - p) / n) + 2e-3, ids


def test_all_segmentations_come_out_once(pieces):
    lattices = segment.Lattices(pieces)
    want = all_paths("th a", pieces)
    keys = [segment.key_at(i, 1) for i in range(20)]
    for found, threshold in drawn(lattices, "th a", keys, len(want) + 5):
        assert {tuple(lattices.piece[d.edges].tolist()) for d in found} == set(want)
        assert threshold == -math.inf


def test_inclusion_scores_are_unbiased(pieces):
    """The sum of probability / inclusion over a sample estimates 1."""
    lattices = segment.Lattices(pieces)
    n = 3000
    keys = [segment.key_at(i, 9) for i in range(n)]
    sums = []
    for found, threshold in drawn(lattices, "the a", keys, 3):
        sums.append(sum(math.exp(d.log_p.sum()) / -math.expm1(-math.exp(d.log_p.sum() - threshold)) for d in found))
    assert abs(np.mean(sums) - 1) < 5 * np.std(sums) / math.sqrt(n) + 1e-6


def test_whole_texts_round_trip(spark, docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        got = segment.sample(df, PATH, k=3)
        texts = Counter((r.doc_id, (r.text or "").replace(segment.MARK, " ")) for r in df.collect())
        spelled = {(r.doc_id, r.text) for r in segment.decode(got, PATH).collect()}
        assert spelled == set(texts)
        rows = got.collect()
        assert len({(r.doc_id, r.sample, tuple(r.ids)) for r in rows}) >= len({(r.doc_id, tuple(r.ids)) for r in rows})
        again = segment.sample(df.repartition(3), PATH, k=3, with_ids=False).collect()
        assert Counter((r.doc_id, r.sample, r.ids_crc32) for r in rows) == Counter((r.doc_id, r.sample, r.ids_crc32) for r in again)
    assert segment.sample(no_docs, PATH).count() == 0


def test_long_words_and_small_cache(pieces, monkeypatch):
    monkeypatch.setattr(segment, "CACHE", 3)
    lattices = segment.Lattices(pieces)
    text = "x" * 5000 + " abc " + "é" * 700
    for found, _ in drawn(lattices, text, [5], 2):
        for d in found:
            assert pieces.model.decode(lattices.piece[d.edges].tolist()) == text
            assert math.isfinite(d.log_p.sum())
    drawn(lattices, "one two three four five", [5], 2)


def test_query_covers_every_document(spark, data_dir, docs):
    rows = queries.QUERIES["op8_gumbel_segmentations"](spark, data_dir).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert all(0 < r.inclusion <= 1 for r in rows)
    assert all(len(r.ids) == 4 * r.n_pieces and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    spelled = segment.decode(spark.createDataFrame(rows), PATH).collect()
    assert {(r.doc_id, r.text) for r in spelled} == {(r.doc_id, (r.text or "").replace(segment.MARK, " ")) for r in docs.collect()}
