"""Sampled segmentations without replacement by Gumbel top-k (operator 8), and decoding.

The lattice of a text has a node per position and an edge per vocabulary piece; a segmentation is a path. Its
probability is the product of its pieces' probabilities, over the sum for all paths. Adding independent Gumbel noise to
the log probabilities of all segmentations and taking the k largest draws k distinct ones without replacement. The
search finds them without listing all: a set of segmentations has a perturbed maximum, a Gumbel value around the
set's log probability, and when a set is split, the part that holds the maximum keeps the value while the others get
values cut off there. The search always opens the set with the largest value (A* whose bound is exact): it
follows the lattice down to one segmentation and leaves behind, for each unit, the set that differs there first.

Where two characters stand side by side in no piece, no piece reaches over, so the lattice of a text is a chain of small
lattices of units (about a word each). These are built once per unit and kept as flat arrays, in which the
units of many texts are walked through together. The inclusion score of a segmentation is the chance that its
perturbed value exceeds the (k + 1)-th: 1 - exp(-exp(log_prob - threshold)); it is 1 if all segmentations were drawn.

A piece's probability follows Zipf's law over the order of the vocabulary, as merge-based models hold ranks instead of
probabilities; characters outside the vocabulary become bytes. Noise is a hash of the row key, the sample and the
place, so a row's result does not depend on its neighbours or on a repeated task.

Defined results: null and empty texts have one segmentation without pieces; very long ones are walked like others, whole. A text with fewer than k segmentations
returns all it has. A null key counts as 0. Rows that repeat a key and a text get equal results. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crosswalk.llm.common import map_batches, texts

MARK = "▁"  # stands for a space
PIECE_ROWS = 200  # texts that are walked through together
CACHE = 250_000  # units whose lattices a task remembers before it starts anew
BLOCK_CHARS = 200_000  # characters of units whose lattices are built side by side
SCALE = 64.0  # keeps the products of piece probabilities within range; it cancels out


class Pieces:
    """Vocabulary of a model as a tree of characters, with probabilities by Zipf's law over its order."""

    def __init__(self, path: str, theta: float):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        plain = [i for i in range(size) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        weight = [(r + 2.0) ** -theta for r in range(len(plain))]
        low = (len(plain) + 2.0) ** -theta
        total = sum(weight) + 256 * low
        self.byte = {int(self.model.id_to_piece(i)[3:5], 16): i for i in range(size) if self.model.is_byte(i)}
        self.byte_p = low / total
        self.p = {self.model.id_to_piece(i): (i, w / total) for i, w in zip(plain, weight)}
        self.longest = max(map(len, self.p))
        # Tree nodes and their steps: (node, character) -> node; node 0 is the root.
        steps: dict[tuple[int, str], int] = {}
        ids, probs, pairs = [-1], [0.0], set()
        for piece, (i, p) in self.p.items():
            node = 0
            for c in piece:
                node = steps.setdefault((node, c), len(ids))
                if node == len(ids):
                    ids.append(-1)
                    probs.append(0.0)
            ids[node], probs[node] = i, p
            pairs.update(zip(piece, piece[1:]))
        self.ids, self.probs = np.array(ids, dtype=np.int32), np.array(probs)
        # Steps as tables: from the root by character; from the nodes that have any, by the number of the character
        # among those that stand beside another in some piece (0: all others). 0 in a table is no step.
        beside = sorted({c for pair in pairs for c in pair})
        number = {c: n for n, c in enumerate(beside, 1)}
        self.number_of = np.zeros(0x110000, dtype=np.int32)
        self.number_of[[ord(c) for c in beside]] = np.arange(1, len(beside) + 1)
        self.pairs = np.zeros((len(beside) + 1, len(beside) + 1), dtype=bool)
        self.pairs[[number[x] for x, _ in pairs], [number[y] for _, y in pairs]] = True
        inner = {node: n for n, node in enumerate(sorted({node for node, _ in steps if node}), 1)}
        self.from_root = np.zeros(0x110000, dtype=np.int32)
        self.row_of = np.zeros(len(ids), dtype=np.int32)
        self.row_of[list(inner)] = list(inner.values())
        self.steps = np.zeros((len(inner) + 1, len(beside) + 1), dtype=np.int32)
        for (node, c), to in steps.items():
            if node:
                self.steps[inner[node], number[c]] = to
            else:
                self.from_root[ord(c)] = to

    def units(self, texts: Sequence[str | None]) -> tuple[pa.StringArray, np.ndarray]:
        """The units of all texts one after the other, and the number of units of each text.

        A text is cut before a mark that follows another character, and between characters that stand side by side in no
        piece. Units are slices of one buffer; none of them becomes a string of Python's.
        """
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        joined = "".join(marked)
        points = code_points(joined)
        number, mark = self.number_of[points], points == ord(MARK)
        cut = np.ones(len(points) + 1, dtype=bool)
        cut[1:-1] = ~self.pairs[number[:-1], number[1:]] | (mark[1:] & ~mark[:-1])
        ends = np.cumsum([len(t) for t in marked], dtype=np.int64)
        cut[ends] = True
        at = np.flatnonzero(cut)
        width = np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))  # bytes of UTF-8 up to each character
        offsets = np.concatenate([[0], width])[at].astype(np.int32)
        counts = np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
        return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(joined.encode())), counts


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)


class Lattices:
    """Lattices of units in flat arrays: node k has the edges ``first[k]`` up to ``first[k + 1]``, longest first.

    A unit is a stretch of text that pieces cannot reach over, so the lattice of a text is a chain of them.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.unit: dict[str, int] = {}  # unit -> its first node
        self.first = np.zeros(1, dtype=np.int64)
        self.to, self.piece = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.prob, self.paths = np.zeros(0), np.zeros(0)
        self.nodes = self.edges = 0

    def starts(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """For each text the first nodes of its units; new units get their lattices."""
        units, counts = self.pieces.units(texts)
        coded = units.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.unit) + len(names) > CACHE:
            self.clear()
        new = [u for u in names if u not in self.unit]
        size = np.cumsum([len(u) for u in new], dtype=np.int64)
        bounds = np.searchsorted(size, np.arange(BLOCK_CHARS, (size[-1] if new else 0) + BLOCK_CHARS, BLOCK_CHARS)).tolist()
        for low, high in zip([0, *bounds], [*bounds, len(new)]):
            self.add(new[low:high])
        nodes = np.fromiter(map(self.unit.__getitem__, names), dtype=np.int64, count=len(names))
        return np.split(nodes[coded.indices.to_numpy()], np.cumsum(counts)[:-1])

    def add(self, units: list[str]) -> None:
        """Build the lattices of new units side by side."""
        if not units:
            return
        pieces, reach = self.pieces, self.pieces.longest
        points = code_points("".join(units))
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        place = np.arange(len(points))
        far = ends - place  # characters up to the end of the unit
        node = place + np.repeat(np.arange(len(units)), sizes)  # each unit has one more node, its end
        weight = np.zeros((len(points), reach))
        ids = np.full((len(points), reach), -1, dtype=np.int32)
        live, number = place, pieces.number_of[points]
        for n in range(reach):
            if n == 0:
                to = pieces.from_root[points]
            else:
                inside = far[live] > n
                live, state = live[inside], state[inside]
                to = pieces.steps[pieces.row_of[state], number[live + n]]
            known = np.flatnonzero(to)
            live, state = live[known], to[known]
            weight[live, n] = pieces.probs[state] * SCALE ** (n + 1)
            ids[live, n] = pieces.ids[state]
        strange = np.flatnonzero(ids[:, 0] < 0)  # characters outside the vocabulary
        spelled = [chr(c).encode("utf-8", "surrogatepass") for c in points[strange].tolist()]
        weight[strange, 0] = [pieces.byte_p ** len(b) * SCALE for b in spelled]
        total = len(points) + len(units)
        paths, beta = np.ones(total + reach), np.ones(total + reach)
        by_far = np.argsort(far, kind="stable")
        bounds = np.searchsorted(far[by_far], np.arange(1, int(far.max()) + 2))
        for d in range(1, int(far.max()) + 1):  # from the ends of all units towards their starts
            own = by_far[bounds[d - 1] : bounds[d]]
            width = min(d, reach)
            ahead = node[own][:, None] + np.arange(1, width + 1)
            share = weight[own, :width] * beta[ahead]
            whole = share.sum(axis=1)
            weight[own, :width] = share / whole[:, None]
            paths[node[own]] = np.minimum(((share > 0) * paths[ahead]).sum(axis=1), 1e300)
            beta[node[own]] = whole
            if d % 16 == 0:  # only ratios of neighbouring sums matter; keep them within range
                beta[node[own][:, None] + np.arange(width)] /= whole[:, None]
        source, back = np.nonzero(weight[:, ::-1])
        n = reach - 1 - back
        to, piece, prob = node[source] + n + 1, ids[source, n], weight[source, n]
        degree = np.zeros(total, dtype=np.int64)
        degree[node] = np.bincount(source, minlength=len(points))
        more_to, more_piece, more_paths = [], [], []
        edge_of = {int(source[e]): e for e in np.flatnonzero(piece < 0)}
        for x, data in zip(strange.tolist(), spelled):
            e, goal = edge_of[x], int(node[x]) + 1
            piece[e] = pieces.byte[data[0]]
            for k, byte in enumerate(data[1:], 1):  # a node between each two bytes
                if k == 1:
                    to[e] = total + len(more_to)
                more_to.append(goal if k == len(data) - 1 else total + len(more_to) + 1)
                more_piece.append(pieces.byte[byte])
                more_paths.append(paths[goal])
        degree = np.concatenate([degree, np.ones(len(more_to), dtype=np.int64)])
        self.unit.update(zip(units, (self.nodes + np.cumsum(sizes + 1) - sizes - 1).tolist()))
        self.first = grown(self.first, self.nodes + 1, self.edges + np.cumsum(degree))
        self.paths = grown(self.paths, self.nodes, np.concatenate([paths[:total], more_paths]))
        self.to = grown(self.to, self.edges, (np.concatenate([to, more_to]) + self.nodes).astype(np.int32))
        self.piece = grown(self.piece, self.edges, np.concatenate([piece, more_piece]).astype(np.int32))
        self.prob = grown(self.prob, self.edges, np.concatenate([prob, np.ones(len(more_to))]))
        self.nodes, self.edges = self.nodes + len(degree), self.edges + len(prob) + len(more_to)

    def walk(self, start: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A random path from each node in ``start``: edges of all paths in order, edges per path, log probabilities.

        A random number serves for up to three steps: where it falls within an edge's share is as random as it was.
        """
        log_p, steps = np.zeros(len(start)), np.zeros(len(start), dtype=np.int64)
        who, node = np.arange(len(start)), start
        taken, step, u = [], 0, np.zeros(0)
        while len(who):
            if step % 3 == 0:
                u = noise(key[who], step)
            edge, last = self.first[node], self.first[node + 1] - 1
            p = self.prob[edge]
            rest = u - p
            on = np.flatnonzero((rest >= 0) & (edge < last))
            while len(on):
                edge[on] += 1
                p_on = self.prob[edge[on]]
                p[on] = p_on
                rest_on = rest[on] - p_on
                rest[on] = rest_on
                on = on[(rest_on >= 0) & (edge[on] < last[on])]
            log_p[who] += np.log(p)
            taken.append((who, edge))
            steps[who] += 1
            step += 1
            node = self.to[edge]
            going = np.flatnonzero(self.first[node + 1] > self.first[node])
            u = np.minimum(np.maximum(1 + rest[going] / p[going], 0.0), 1 - 2.0**-53)
            who, node = who[going], node[going]
        begin = np.cumsum(steps) - steps
        edges = np.empty(int(steps.sum()), dtype=np.int64)
        for n, (who, edge) in enumerate(taken):
            edges[begin[who] + n] = edge
        return edges, steps, log_p

    def walk_around(self, node: int, avoid: list[tuple[int, ...]], key: int) -> tuple[list[int], float]:
        """A random path from ``node`` that is none of the paths in ``avoid`` (edges), with its log probability among
        all paths. Each edge keeps the share of its paths that are not to be avoided."""
        path: list[int] = []
        log_p, step = 0.0, 0
        while self.first[node + 1] > self.first[node]:
            edges = range(int(self.first[node]), int(self.first[node + 1]))
            share = []
            for e in edges:
                through = [a for a in avoid if a[step] == e]
                left = float(self.paths[self.to[e]]) - len(through)
                gone = sum(self.path_p(a[step:]) for a in through)
                share.append(max(float(self.prob[e]) - gone, 1e-300) if left > 0 else 0.0)
            u = noise_at(key, step) * sum(share)
            pick = max(k for k, s in enumerate(share) if s)
            for k, s in enumerate(share):
                u -= s
                if s and u < 0:
                    pick = k
                    break
            edge = edges[pick]
            path.append(edge)
            log_p += math.log(self.prob[edge])
            avoid = [a for a in avoid if a[step] == edge]
            node, step = int(self.to[edge]), step + 1
        return path, log_p

    def path_p(self, path: Sequence[int]) -> float:
        return math.prod(self.prob[list(path)].tolist())


def grown(array: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``array`` with ``new`` behind its first ``used`` values, in a larger array where there is no room."""
    if used + len(new) > len(array):
        larger = np.zeros(max(2 * len(array), used + len(new)), dtype=array.dtype)
        larger[:used] = array[:used]
        array = larger
    array[used : used + len(new)] = new
    return array


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


ODD = 0x9E3779B97F4A7C15
FULL = (1 << 64) - 1


def keyed(key: np.ndarray, place) -> np.ndarray:
    """Keys derived from keys and places."""
    place = place.astype(np.uint64) if isinstance(place, np.ndarray) else np.uint64(place)
    with np.errstate(over="ignore"):
        return mixed(key + (place + np.uint64(1)) * np.uint64(ODD))


def noise(key: np.ndarray, place) -> np.ndarray:
    """Even numbers in (0, 1)."""
    return ((keyed(key, place) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def key_at(key: int, place: int) -> int:
    """``keyed`` for one plain number."""
    x = (key + (place + 1) * ODD) & FULL
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & FULL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & FULL
    return x ^ (x >> 31)


def noise_at(key: int, place: int) -> float:
    return ((key_at(key, place) >> 11) + 0.5) * 2.0**-53


def cut_gumbel(phi: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values around ``phi``, given that they lie below ``top``."""
    with np.errstate(over="ignore", divide="ignore"):
        return -np.logaddexp(-top, np.log(-np.log(u)) - phi)


def log_rest(log_p: np.ndarray) -> np.ndarray:
    """log(1 - p) for p up to and including 1."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(np.minimum(log_p, -1e-300)))


class Drawn:
    """One segmentation: its edges, and per unit how many of them and their log probability; ``value`` is its perturbed log probability."""

    def __init__(self, edges: np.ndarray, steps: np.ndarray, log_p: np.ndarray, value: float):
        self.edges, self.steps, self.log_p, self.value = edges, steps, log_p, value
        self.ends = np.cumsum(steps)

    def unit(self, n: int) -> tuple[int, ...]:
        return tuple(self.edges[self.ends[n] - self.steps[n] : self.ends[n]].tolist())


def draw(lattices: Lattices, starts: list[np.ndarray], keys: Sequence[int], k: int) -> list[tuple[list[Drawn], float]]:
    """For each text (its units' first nodes) up to ``k`` segmentations and the threshold, the (k + 1)-th value.

    The texts take their walks together, one sample after the other.
    """
    # Open sets of each text: the segmentation they branch off from, values by unit, first unit, paths to avoid there.
    sets: list[list[tuple[Drawn, np.ndarray, int, list]]] = [[] for _ in starts]
    found: list[list[Drawn]] = [[] for _ in starts]
    threshold = [-math.inf] * len(starts)
    # A job: text, value, and where the set branches off (segmentation, unit, path there, its log probability, avoided).
    jobs = [(t, -math.log(-math.log(noise_at(key_at(keys[t], 0), 0))), None) for t in range(len(starts))]
    for number in range(k):
        heads = [job[2][1] + 1 if job[2] else 0 for job in jobs]
        tails = [starts[job[0]][head:] for job, head in zip(jobs, heads)]
        sizes = np.array([len(x) for x in tails], dtype=np.int64)
        row_key = np.repeat(np.array([key_at(keys[job[0]], 2 * number) for job in jobs], dtype=np.uint64), sizes)
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - np.array(heads, dtype=np.int64), sizes)
        edges, steps, log_p = lattices.walk(np.concatenate(tails), keyed(row_key, place)) if jobs else (None, None, None)
        at = at_edge = 0
        open_sets: list[tuple[int, Drawn, int, list, int]] = []
        for (t, value, branch), size in zip(jobs, sizes.tolist()):
            own_steps, own_log = steps[at : at + size], log_p[at : at + size]
            n_edges = int(own_steps.sum())
            own_edges = edges[at_edge : at_edge + n_edges]
            at, at_edge, offset, avoid = at + size, at_edge + n_edges, 0, []
            if branch:
                base, offset, path, path_log, avoid = branch
                before = int(base.ends[offset] - base.steps[offset])
                own_edges = np.concatenate([base.edges[:before], np.array(path, dtype=np.int64), own_edges])
                own_steps = np.concatenate([base.steps[:offset], [len(path)], own_steps])
                own_log = np.concatenate([base.log_p[:offset], [path_log], own_log])
            new = Drawn(own_edges, own_steps, own_log, value)
            found[t].append(new)
            if offset < len(own_log):
                open_sets.append((t, new, offset, avoid, key_at(keys[t], 2 * number + 1)))
        for (t, new, offset, avoid, _), values in zip(open_sets, branch_values(lattices, starts, open_sets)):
            sets[t].append((new, values, offset, avoid))
        jobs = [open_best(lattices, t, starts[t], sets[t], key_at(keys[t], 2 * number + 2), number + 1 < k) for t, *_ in jobs]
        jobs = [job for job in jobs if job]
    for t, value, _ in jobs:
        threshold[t] = value
    return list(zip(found, threshold))


def branch_values(lattices: Lattices, starts: list[np.ndarray], drawn: list[tuple[int, Drawn, int, list, int]]) -> list[np.ndarray]:
    """For each (text, segmentation, first unit, paths to avoid there, key) the perturbed values of the sets that
    differ from the segmentation first at each unit from the first one on."""
    if not drawn:
        return []
    tails = [new.log_p[offset:] for _, new, offset, _, _ in drawn]
    before = [float(new.log_p[:offset].sum()) + np.cumsum(tail) - tail for (_, new, offset, _, _), tail in zip(drawn, tails)]
    sizes = np.array([len(tail) for tail in tails], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    phi = np.concatenate(before) + log_rest(np.concatenate(tails))
    phi[lattices.paths[np.concatenate([starts[t][offset:] for t, _, offset, _, _ in drawn])] <= 1] = -math.inf
    for at, own, (t, new, offset, avoid, _) in zip(first.tolist(), before, drawn):
        if avoid:  # paths drawn earlier at the first of these units are not in its set either
            gone = sum(lattices.path_p(a) for a in [*avoid, new.unit(offset)])
            left = float(lattices.paths[starts[t][offset]]) - len(avoid) - 1
            phi[at] = float(own[0]) + math.log(max(1.0 - gone, 1e-300)) if left > 0 else -math.inf
    key = np.repeat(np.array([key for *_, key in drawn], dtype=np.uint64), sizes)
    place = np.arange(len(phi)) - np.repeat(first - np.array([offset for _, _, offset, _, _ in drawn]), sizes)
    top = np.repeat(np.array([new.value for _, new, _, _, _ in drawn]), sizes)
    return np.split(cut_gumbel(phi, top, noise(key, place)), first[1:])


def open_best(lattices: Lattices, t: int, start: np.ndarray, sets: list, key: int, follow: bool) -> tuple | None:
    """Take the open set with the largest value; if it is to be followed, draw the path at the unit that differs."""
    tops = [int(values.argmax()) for _, values, _, _ in sets]
    best = max(range(len(sets)), key=lambda s: sets[s][1][tops[s]], default=None)
    if best is None or sets[best][1][tops[best]] == -math.inf:
        return None
    base, values, offset, avoid = sets[best]
    value = float(values[tops[best]])
    if not follow:
        return t, value, None
    unit = offset + tops[best]
    values[tops[best]] = -math.inf
    avoid = [*(avoid if unit == offset else []), base.unit(unit)]
    path, log_p = lattices.walk_around(int(start[unit]), avoid, key_at(key, unit))
    return t, value, (base, unit, path, log_p, avoid)


def inclusion(log_prob: float, threshold: float) -> float:
    return -math.expm1(-math.exp(min(700.0, log_prob - threshold))) if threshold > -math.inf else 1.0


_open: dict[tuple, Lattices] = {}  # one vocabulary per task process


def sample(docs: DataFrame, model: str, k: int = 2, theta: float = 1.0, seed: int = 7, with_ids: bool = True, packed: bool = False) -> DataFrame:
    """Per row and sample (from 1): ``doc_id``, ``sample``, ``n_pieces``, ``ids_crc32`` (of the ids as little-endian
    unsigned 32-bit numbers), ``log_prob``, ``value`` (perturbed), ``inclusion`` and, if asked for, ``ids``: an array, or, ``packed``,
    those numbers one after the other, which takes a fraction of the time to store."""

    def run(batch):
        lattices = _open.get((model, theta)) or _open.setdefault((model, theta), Lattices(Pieces(model, theta)))
        starts = lattices.starts(batch.column("text").to_pylist())
        ids = batch.column("doc_id")
        keys = [key_at((i or 0) & FULL, seed) for i in ids.to_pylist()]
        found = draw(lattices, starts, keys, k)
        every = [d for drawn, _ in found for d in drawn]
        pieces = [lattices.piece[d.edges] for d in every]
        data = [p.tobytes() for p in pieces]  # little-endian, as the machine is
        log_prob = [float(d.log_p.sum()) for d in every]
        thresholds = [threshold for drawn, threshold in found for _ in drawn]
        row = np.repeat(np.arange(len(found)), [len(drawn) for drawn, _ in found])
        out = {
            "doc_id": ids.take(pa.array(row)), "sample": [n for drawn, _ in found for n in range(1, len(drawn) + 1)], "n_pieces": [len(p) for p in pieces],
            "ids_crc32": [zlib.crc32(b) for b in data], "log_prob": log_prob, "value": [d.value for d in every],
            "inclusion": [inclusion(*x) for x in zip(log_prob, thresholds)],
        }
        return out | ({"ids": data if packed else [p.tolist() for p in pieces]} if with_ids else {})

    schema = "doc_id long, sample int, n_pieces long, ids_crc32 long, log_prob double, value double, inclusion double"
    return map_batches(texts(docs), run, schema + (f", ids {'binary' if packed else 'array<int>'}" if with_ids else ""), PIECE_ROWS)


def decode(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``doc_id``, ``sample`` and ``text``: what the pieces spell. ``ids`` are arrays or packed; null ids give a null text."""

    def run(batch):
        lattices = _open.get((model, 1.0)) or _open.setdefault((model, 1.0), Lattices(Pieces(model, 1.0)))
        ids = [np.frombuffer(i, dtype="<u4").tolist() if isinstance(i, bytes) else i for i in batch.column("ids").to_pylist()]
        spelled = [None if i is None else lattices.pieces.model.decode(i) for i in ids]
        return {"doc_id": batch.column("doc_id"), "sample": batch.column("sample"), "text": spelled}

    return map_batches(rows.select("doc_id", "sample", rows[ids].alias("ids")), run, "doc_id long, sample int, text string")
