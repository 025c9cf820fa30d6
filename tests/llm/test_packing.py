import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from crosswalk.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_laws(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[i, piece, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_query_keeps_the_laws(spark, data_dir, docs):
    rows = queries.QUERIES["op10_large_item_packing"](spark, data_dir).collect()
    n = check_laws(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert n <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def test_odd_rows(odd_docs, no_docs):
    check_laws(packing.pack(odd_docs, PATH, 64).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], 64)
    assert packing.pack(no_docs, PATH).count() == 0


def fewest(lengths, capacity):
    """Best-fit decreasing, item by item."""
    free = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k in range(len(free)) if free[k] >= length]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= length
        else:
            free.append(capacity - length)
    return len(free)


@pytest.mark.parametrize("seed", range(25))
def test_plan_places_every_item_once_and_well(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 30, 97, 2048])
    lengths = [min(capacity, max(1, int(rnd.expovariate(3 / capacity)))) for _ in range(rnd.randint(0, 600))]
    counts = Counter(lengths)
    runs = packing.plan(counts, capacity)
    spots, items = defaultdict(list), Counter()
    for length, first, n, sequence, offset in runs:
        assert n > 0
        for k in range(n):
            items[length, first + k] += 1
            spots[sequence + k].append((offset, length))
    assert items == Counter((length, k) for length, n in counts.items() for k in range(n))
    for parts in spots.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in parts) <= 2
    assert len(spots) <= 1.02 * fewest(lengths, capacity) + 1


def test_plan_grows_with_the_lengths_not_with_the_rows():
    rnd = random.Random(2)
    shape = Counter(min(2048, max(1, int(rnd.expovariate(1 / 700)))) for _ in range(200_000))
    small, large = packing.plan(shape, 2048), packing.plan({k: 10_000 * n for k, n in shape.items()}, 2048)
    assert len(large) < 3 * len(small) and len(large) < 50_000


def test_a_hot_length_is_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECE_ROWS", 10)
    docs = spark.createDataFrame([(i, "the same words") for i in range(500)], "doc_id long, text string")
    check_laws(packing.pack(docs, PATH, 16).collect(), [(i, "the same words") for i in range(500)], 16)


def test_ids_are_put_together_in_steps(monkeypatch):
    words = ["The", "same", "words,", "it's", "12", "", "wörds.", "again"] * 50_000
    known = packing.WordIds(PATH)
    known.encode(pa.array(words))
    tracemalloc.start()
    ids, begin = known.encode(pa.array(words))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * len(words)  # the results and their parts take 30 bytes a word
    monkeypatch.setattr(packing, "STEP", 3)
    few, few_begin = known.encode(pa.array(words[:20]))
    assert few.tolist() == ids[: len(few)].tolist() and few_begin.tolist() == begin[:21].tolist()
    none, only = known.encode(pa.array([], type=pa.string()))
    assert len(none) == 0 and only.tolist() == [0]
    tokenizer = Tokenizer.from_file(PATH)
    assert few.tolist() == [i for w in words[:20] for i in tokenizer.encode(w, add_special_tokens=False).ids]
