"""Encoding to SentencePiece pieces, decoding, and sampled segmentations without replacement.

The canonical ids are the model's own.  Pieces never cross from a character to a following space, nor, in
a vocabulary without them, a newline, so a text is encoded in chunks (spaces or a newline and what follows
up to the next), each different chunk once.

Sampling takes the pieces that fit a chunk as the edges of a lattice, weighed as in a unigram model.
Backward sums give every edge the probability that a random segmentation goes on with it.  The k best of
all segmentations under Gumbel noise are k draws without replacement, and a perturbed A* search finds
them without listing any others: a region of segmentations has the largest noise of its members, drawn
from its total probability and below that of the region it was split from.  The best region is opened:
its best member is drawn, and the rest falls into the regions that leave this path at each of its
edges.  The next largest value, the threshold, gives each draw the probability of being among the k.
Random numbers are hashes of the row's key, so they do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import Prefixes, lists, mix, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, SEED = 2, 5
#: Bytes of lattices that a worker keeps from slice to slice; a position takes about POSITION of them.
KEPT, POSITION = 280 << 20, 35
#: Bytes of text that a worker looks at together; new text takes some 190 times as much while its lattices are made.
AT_ONCE = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a hash that tables of pieces and chunks are looked up by; a worker's tables take 13 bytes for each value of them.
BITS = 22

SAMPLE = "rank: int, n_tokens: long, log_prob: double, value: double, inclusion: double"
IDS = f"doc_id long, ids array<int>, exact boolean, samples array<struct<{SAMPLE}, ids: array<int>>>"
ENCODED = IDS.replace("exact", "decoded string, exact")
DIGEST = f"doc_id long, n_tokens long, ids_sha256 string, round_trip boolean, samples array<struct<{SAMPLE}, ids_sha256: string>>"


def uniform(keys: np.ndarray) -> np.ndarray:
    """In (0, 1), one for each 64-bit key."""
    return ((mix(keys) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices of runs one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Vocabulary:
    """Pieces by the hash of their bytes (a space for the space mark), with the weights of a lattice's edges."""

    def __init__(self, model: bytes, bits: int = BITS):
        self.bits, self.low = np.uint64(bits), np.uint64((1 << bits) - 1)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.byte, pieces = np.zeros(256, np.int32), {}
        scores = []
        for k in range(self.model.get_piece_size()):
            if self.model.is_byte(k):
                self.byte[int(self.model.id_to_piece(k)[3:5], 16)] = k
            elif not (self.model.is_control(k) or self.model.is_unknown(k) or self.model.is_unused(k)):
                pieces[self.model.id_to_piece(k).replace("▁", " ").encode()] = k
                scores.append(self.model.get_score(k))
        self.lines = not any(b"\n" in p for p in pieces)  # whether a newline ends every piece
        self.space = [pieces[b" "]] if b" " in pieces else [int(self.byte[0x20])]
        ids = np.array(list(pieces.values()), np.int32)
        scores = np.array(scores)
        # merges are scored by their rank, which frequencies fall with as by Zipf's law
        weight = -np.log(2 - scores) if scores.min() < -1000 else scores
        self.rare = float(weight.min()) - 1
        self.longest = max(len(p) for p in pieces)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = ends - [len(p) for p in pieces]
        hashes = mix(Prefixes(data).of(starts, ends) + (ends - starts).astype(np.uint64))
        order = np.argsort(hashes)
        self.hashes, self.ids, self.weight = hashes[order], ids[order], weight[order]
        # by the lowest bits of a hash: a piece that has them (-1: none, -2: several)
        low = self.hashes & self.low
        self.place = np.full(1 << bits, -1, np.int32)
        self.place[low] = np.arange(len(low))
        names, times = np.unique(low, return_counts=True)
        self.place[names[times > 1]] = -2
        self.starts = np.zeros(1 << bits, bool)  # of pieces, the whole ones too: what may go on
        for k in range(1, self.longest + 1):
            some = starts[ends - starts >= k]
            self.starts[mix(Prefixes(data).of(some, some + k) + np.uint64(k)) & self.low] = True

    def find(self, hashes: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``hashes`` are pieces, their places in the vocabulary); ``low`` are the hashes' lowest bits."""
        at = self.place[low]
        some = np.flatnonzero(at != -1)
        at = at[some]
        several = np.flatnonzero(at == -2)
        at[several] = np.minimum(np.searchsorted(self.hashes, hashes[some[several]]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        return some[hit], at[hit]


class Lattices:
    """Canonical ids and lattices of different chunks, side by side.

    Chunk ``c`` has positions ``first[c]`` to its end, one for each byte and one after the last.  The
    edges of position ``p`` are ``edge[p]:edge[p + 1]``, the likeliest first: how far they lead, their
    piece, and the logarithm and the running total of their probabilities.
    """

    def __init__(self, vocabulary: Vocabulary, kept: int):
        self.vocabulary, self.kept = vocabulary, kept
        self.clear()

    def clear(self):
        # chunks by two parts of their hash: their number and 1, or 0
        self.place = [np.zeros(int(self.vocabulary.low) + 1, np.int32) for _ in range(2)]
        self.hashes = np.zeros(1, np.uint64)
        self.first = np.zeros(1, np.int64)
        self.id_at, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)
        vocabulary = self.vocabulary
        self.edge, self.length = np.zeros(1, np.int64), np.zeros(0, np.uint8 if vocabulary.longest < 256 else np.int32)
        self.piece = np.zeros(0, np.uint16 if vocabulary.model.get_piece_size() <= 1 << 16 else np.int32)
        self.log_prob, self.total = np.zeros(0, np.float32), np.zeros(0, np.float32)

    def position(self, edge: int) -> int:
        return int(np.searchsorted(self.edge, edge, "right")) - 1

    def slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Each chunk's number, after adding those not seen yet."""
        if self.first[-1] * POSITION > self.kept:
            self.clear()
        bits, mask = self.vocabulary.bits, self.vocabulary.low
        low, high = hashes & mask, (hashes >> bits) & mask
        at = self.place[0][low]
        other = np.flatnonzero(self.hashes[at] != hashes)
        at[other] = self.place[1][high[other]]
        new = other[self.hashes[at[other]] != hashes[other]]
        if len(new):
            unique, where, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            size = end[new[where]] - start[new[where]]
            self._add(data[_ragged(start[new[where]], size)], np.concatenate([[0], np.cumsum(size)]))
            numbers = np.arange(len(self.hashes), len(self.hashes) + len(unique), dtype=np.int32)
            self.hashes = np.concatenate([self.hashes, unique])
            free = self.place[0][unique & mask] == 0
            self.place[0][unique[free] & mask] = numbers[free]
            self.place[1][(unique[~free] >> bits) & mask] = numbers[~free]  # one pushed out is added again
            at[new] = numbers[back]
        return at.astype(np.int64) - 1

    def _add(self, data: np.ndarray, offsets: np.ndarray):
        vocabulary, n = self.vocabulary, len(offsets) - 1
        text = data.tobytes()
        # the model puts a space before every text but the empty one; before a newline it is a piece of its own
        opens = data[offsets[:-1]] == 0x20
        ids = vocabulary.model.encode([text[a + o:b].decode() for a, b, o in zip(offsets[:-1], offsets[1:], opens)])
        ids = [(x or vocabulary.space) if o else x[len(vocabulary.space):] for x, o in zip(ids, opens)]
        self.id_at = np.concatenate([self.id_at, self.id_at[-1] + np.cumsum([len(x) for x in ids])])
        self.ids = np.concatenate([self.ids, np.array([y for x in ids for y in x], np.int32)])

        left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
        begins = (data & 0xC0) != 0x80
        prefixes, found_at, found = Prefixes(data), [], []
        chars = np.diff(np.append(np.flatnonzero(begins), len(data)))
        width = np.zeros(len(data), np.int64)
        width[begins] = chars
        alone = np.zeros(len(data), bool)
        here = np.flatnonzero(begins)
        for k in range(1, vocabulary.longest + 1):
            here = here[left[here] >= k]
            hashes = mix(prefixes.of(here, here + k) + np.uint64(k))
            low = hashes & vocabulary.low
            some, place = vocabulary.find(hashes, low)
            begin = here[some]
            alone[begin[width[begin] == k]] = True
            found_at.append(begin)
            found.append(place)
            here = here[vocabulary.starts[low]]
        # a character that is no piece is spelled in bytes
        spelled = np.flatnonzero(np.repeat((~alone)[begins], chars))
        # edges by the byte they start at, and the shorter first
        held = np.zeros(len(data), np.int64)
        for begin in (*found_at, spelled):
            held[begin] += 1
        begins_at = np.cumsum(held) - held
        at = np.repeat(np.arange(len(data)), held)
        lengths, pieces, weights = np.empty(len(at), np.int64), np.empty(len(at), np.int32), np.empty(len(at))
        for k, (begin, place) in enumerate(zip(found_at, found), 1):
            spot = begins_at[begin]
            lengths[spot], pieces[spot], weights[spot] = k, vocabulary.ids[place], vocabulary.weight[place]
            begins_at[begin] += 1
        spot = begins_at[spelled]
        lengths[spot], pieces[spot], weights[spot] = 1, vocabulary.byte[data[spelled]], vocabulary.rare
        # from bytes to positions: each chunk has one more
        place = at + np.repeat(np.arange(n), np.diff(offsets))[at]
        total = np.zeros(len(data) + n)  # log of the sum over all ways to the end
        remaining = left[at]
        most = int(remaining.max()) if len(remaining) else 0
        order = np.argsort(remaining.astype(np.uint16) if most < 65536 else remaining, kind="stable")
        cuts = np.searchsorted(remaining[order], np.arange(1, most + 2))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo == hi:
                continue
            some = order[lo:hi]
            from_, value = place[some], weights[some] + total[place[some] + lengths[some]]
            new = np.flatnonzero(np.concatenate([[True], from_[1:] != from_[:-1]]))
            high = np.maximum.reduceat(value, new)
            sums = np.add.reduceat(np.exp(value - np.repeat(high, np.diff(np.append(new, len(some))))), new)
            total[from_[new]] = high + np.log(sums)
        log_prob = np.minimum(weights + total[place + lengths] - total[place], 0.0)
        prob = np.exp(log_prob)
        # the likeliest edge of each place comes first
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else place
        size = np.diff(np.append(first, len(place)))
        top = np.flatnonzero(prob == np.repeat(np.maximum.reduceat(prob, first), size)) if len(place) else place
        _, one = np.unique(place[top], return_index=True)
        top = top[one]
        for values in (lengths, pieces, log_prob, prob):
            values[first], values[top] = values[top], values[first]
        edge = np.zeros(len(data) + n + 1, np.int64)
        edge[place[first] + 1] = size
        np.cumsum(edge, out=edge)
        # whole numbers add up alike whatever else is in the slice
        running = np.concatenate([[0], np.cumsum(np.round(prob * 2.0**32).astype(np.int64))])
        running = (running[1:] - running[edge[place]]) * 2.0**-32
        running[edge[1:][np.diff(edge) > 0] - 1] = 1.0
        base = self.first[-1]
        self.first = np.concatenate([self.first, base + offsets[1:] + np.arange(1, n + 1)])
        self.edge = np.concatenate([self.edge, self.edge[-1] + edge[1:]])
        self.length = np.concatenate([self.length, lengths.astype(self.length.dtype)])
        self.piece = np.concatenate([self.piece, pieces.astype(self.piece.dtype)])
        self.log_prob = np.concatenate([self.log_prob, log_prob.astype(np.float32)])
        self.total = np.concatenate([self.total, running.astype(np.float32)])

    def walk(self, position: np.ndarray, end: np.ndarray, keys: np.ndarray):
        """Random ways from ``position`` to ``end``, all side by side: (edges, how many each way has)."""
        count, parts = np.zeros(len(position), np.int64), []
        active, step = np.flatnonzero(position < end), np.uint64(0)
        position = position.copy()
        while len(active):
            here = position[active]
            step += np.uint64(1)
            with np.errstate(over="ignore"):
                chosen = uniform(keys[active] + step * _STEP).astype(np.float32)
            edge = self.edge[here]
            past = np.flatnonzero(self.total[edge] <= chosen)
            while len(past):  # the last edge's total is 1
                past = past[edge[past] + 1 < self.edge[here[past] + 1]]
                edge[past] += 1
                past = past[self.total[edge[past]] <= chosen[past]]
            parts.append((active, edge))
            position[active] = here + self.length[edge]
            count[active] += 1
            active = active[position[active] < end[active]]
        out = np.empty(int(count.sum()), np.int64)
        first = np.cumsum(count) - count
        for k, (who, edge) in enumerate(parts):
            out[first[who] + k] = edge
        return out, count


class Regions:
    """Of each of several texts, the regions that leave a path at one of its edges."""

    def __init__(self, lattices: Lattices, paths: list, starts: list, mass: np.ndarray, keys: np.ndarray, gone: list):
        size = np.array([len(p) - s for p, s in zip(paths, starts)], np.int64)
        self.ends = np.cumsum(size)
        self.edges = np.concatenate([p[s:] for p, s in zip(paths, starts)]) if len(paths) else np.zeros(0, np.int64)
        first = self.ends - size
        log_prob = lattices.log_prob[self.edges].astype(float)
        self.rest = -np.expm1(log_prob)  # what leaves the path at this edge
        for k in (k for k, g in enumerate(gone) if g and size[k]):
            at = lattices.position(self.edges[first[k]])
            others = lattices.edge[at + 1] - lattices.edge[at] > len(gone[k]) + 1
            left = self.rest[first[k]] - np.exp(lattices.log_prob[gone[k]].astype(float)).sum()
            self.rest[first[k]] = max(0.0, left) if others else 0.0
        before = np.cumsum(log_prob) - log_prob
        full = size > 0
        before -= np.repeat(before[first[full]] - mass[full], size[full])
        self.before = before
        numbers = np.arange(len(self.edges), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64)
        noise = -np.log(uniform(mix(np.repeat(keys, size) + numbers)))
        with np.errstate(divide="ignore"):
            self.free = before + np.log(self.rest) - np.log(noise)  # the largest value of each, without a bound

    def best(self, k: int, most: int) -> np.ndarray:
        """Places of up to ``most`` regions of text ``k`` with the largest values."""
        lo = int(self.ends[k - 1]) if k else 0
        free = self.free[lo:self.ends[k]]
        some = np.argpartition(-free, most)[:most] if len(free) > most else np.arange(len(free))
        return lo + some[self.rest[lo + some] > 1e-15]


def bounded(free: float, bound: float) -> float:
    """The value of a region that is known to lie below ``bound``."""
    return float(-np.logaddexp(-bound, -free))


def sampled(lattices: Lattices, begin, stop, row, keys, k: int) -> list:
    """For each text (``keys``), up to ``k`` (edges, log probability, value, inclusion).

    Its chunks, those of its ``row``, reach from ``begin`` to ``stop``.  The texts are searched side by
    side: each round draws the next best segmentation of every one.
    """
    n = len(keys)
    per_row = np.bincount(row, minlength=n)
    chunk_end = np.cumsum(per_row)
    chunk_at = chunk_end - per_row
    in_row = (np.arange(len(row)) - chunk_at[row]).astype(np.uint64)

    def ways(draw: int, some):
        """Random ways through some chunks, the same ones whatever others there are."""
        own = mix(keys ^ np.uint64(0xD1B54A32D192ED03 + draw))
        edges, count = lattices.walk(begin[some], stop[some], mix(own[row[some]] + in_row[some]))
        return edges, count, np.concatenate([[0], np.cumsum(count)])

    edges, count, cut = ways(0, slice(None))
    paths = [edges[cut[a]:cut[b]] for a, b in zip(chunk_at, chunk_end)]
    owners = [np.repeat(np.arange(a, b), count[a:b]) for a, b in zip(chunk_at, chunk_end)]
    draws = lambda j: mix(keys + np.full(1, j, np.uint64) * _STEP)
    values = -np.log(-np.log(uniform(draws(1))))
    starts, mass, gone = [0] * n, np.zeros(n), [[] for _ in range(n)]
    out, heaps, alive, number = [[] for _ in range(n)], [[] for _ in range(n)], list(range(n)), 0
    for draw in range(k):
        found = Regions(
            lattices, [paths[r] for r in alive], [starts[r] for r in alive], mass[alive], draws(2 + draw)[alive], [gone[r] for r in alive]
        )
        for at, r in enumerate(alive):
            out[r].append((paths[r], float(lattices.log_prob[paths[r]].sum(dtype=float)), float(values[r])))
            lo = int(found.ends[at - 1]) if at else 0
            for b in found.best(at, k - draw):
                place = starts[r] + int(b) - lo
                left = [*(gone[r] if b == lo else ()), int(found.edges[b])]
                number += 1
                heapq.heappush(heaps[r], (
                    -bounded(float(found.free[b]), float(values[r])), number, place, float(found.before[b]), left, paths[r], owners[r],
                ))
        alive = [r for r in alive if heaps[r]]
        if draw + 1 == k or not alive:
            break
        picks, firsts = uniform(draws(100 + draw)), []
        for r in alive:
            value, _, place, mass[r], gone[r], path, owner = heapq.heappop(heaps[r])
            values[r], starts[r] = -value, place
            at = lattices.position(path[place])
            others = np.arange(lattices.edge[at], lattices.edge[at + 1])
            others = others[~np.isin(others, gone[r])]
            log_prob = lattices.log_prob[others].astype(float)
            weight = np.cumsum(np.exp(log_prob - log_prob.max()))
            edge = int(others[min(int(np.searchsorted(weight, picks[r] * weight[-1], "right")), len(others) - 1)])
            firsts.append((path[:place], edge, owner[:place], int(owner[place]), int(at)))
        opened = np.array([at + int(lattices.length[edge]) for _, edge, _, _, at in firsts])
        chunks = np.array([chunk for _, _, _, chunk, _ in firsts])
        inner, count = lattices.walk(opened, stop[chunks], draws(200 + draw)[alive])
        inner_end = np.cumsum(count)
        left = chunk_end[alive] - chunks - 1
        edges, per_chunk, cut = ways(draw + 1, _ragged(chunks + 1, left))
        tail = 0
        for at, (r, (head, edge, owner, chunk, _)) in enumerate(zip(alive, firsts)):
            middle = inner[inner_end[at] - count[at]:inner_end[at]]
            paths[r] = np.concatenate([head, [edge], middle, edges[cut[tail]:cut[tail + left[at]]]])
            owners[r] = np.concatenate([
                owner, np.full(1 + len(middle), chunk), np.repeat(np.arange(chunk + 1, chunk_end[r]), per_chunk[tail:tail + left[at]]),
            ])
            tail += left[at]
    result = []
    for r in range(n):
        limit = -heaps[r][0][0] if heaps[r] else None
        result.append([
            (lattices.piece[e], round(p, 6), round(v, 6), round(float(-np.expm1(-np.exp(min(p - limit, 700.0)))), 6) if limit is not None else 1.0)
            for e, p, v in out[r]
        ])
    return result


def _chunks(data: np.ndarray, offsets: np.ndarray, lines: bool):
    """The bytes with a space before every row, and each chunk's (row, start, end)."""
    offsets = offsets + np.arange(len(offsets))
    spaced = np.full(offsets[-1], 0x20, np.uint8)
    keep = np.ones(offsets[-1], bool)
    keep[offsets[:-1]] = False
    spaced[keep] = data
    space = spaced == 0x20
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[offsets[:-1]] = True
    if lines:
        begin |= spaced == 0x0A
    start = np.flatnonzero(begin)
    return spaced, np.searchsorted(offsets, start, "right") - 1, start, np.append(start[1:], offsets[-1])


def _plain(column: pa.Array) -> pa.Array:
    """Text with the space mark itself read as the space that the model takes it for."""
    return pc.replace_substring(column, "▁", " ")


def _encoder(model: bytes, k: int, seed: int, kept: int = KEPT, at_once: int = AT_ONCE, bits: int = BITS):
    def encode(batches):
        vocabulary = Vocabulary(model, bits)
        lattices = Lattices(vocabulary, kept)
        for batch in batches:
            ids = batch.column(0)
            keys = mix(np.array(ids.fill_null(-1)).astype(np.int64).view(np.uint64) * _STEP + np.uint64(seed))
            for first, data, offsets in slices(_plain(batch.column(1)), at_once):
                n = len(offsets) - 1
                spaced, row, start, end = _chunks(data, offsets, vocabulary.lines)
                hashes = mix(Prefixes(spaced).of(start, end) + (end - start).astype(np.uint64))
                slot = lattices.slots(spaced, start, end, hashes)
                per_row = np.bincount(row, minlength=n)
                begin, stop = lattices.first[slot], lattices.first[slot + 1] - 1
                # a row of no text has no segmentation: its chunk is the space put before it
                blank = np.diff(offsets) == 0
                begin = np.where(blank[row], stop, begin)
                samples = sampled(lattices, begin, stop, row, keys[first:first + n], k)
                size = np.where(blank[row], 0, lattices.id_at[slot + 1] - lattices.id_at[slot])
                canonical = lattices.ids[_ragged(lattices.id_at[slot], size)]
                cut = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per_row)])]
                texts = vocabulary.model.decode([canonical[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])])
                yield Encoded(ids.slice(first, n), batch.column(1).slice(first, n), texts, canonical, cut, samples)

    return encode


class Encoded(NamedTuple):
    """A slice of rows: their ids one after the other, cut at ``cut``, and what was drawn for each."""

    doc_id: pa.Array
    text: pa.Array
    decoded: list
    ids: np.ndarray
    cut: np.ndarray
    drawn: list

    def exact(self) -> pa.Array:
        """Whether decoding gives the text again."""
        return pa.array([(t or "") == d for t, d in zip(self.text.to_pylist(), self.decoded)], pa.bool_())

    def samples(self, name: str, last: Callable[[list], pa.Array]) -> pa.Array:
        """Lists of structs; ``last`` makes their last field of all drawn ids."""
        flat = [one for drawn in self.drawn for one in drawn]
        numbers = [np.array([one[k] for one in flat], float) for k in (1, 2, 3)]
        ranks = np.array([r + 1 for drawn in self.drawn for r in range(len(drawn))], np.int32)
        sizes = np.array([len(one[0]) for one in flat], np.int64)
        fields = [pa.array(ranks), pa.array(sizes), *map(pa.array, numbers), last([one[0] for one in flat])]
        structs = pa.StructArray.from_arrays(fields, ["rank", "n_tokens", "log_prob", "value", "inclusion", name])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, self.drawn)]).astype(np.int32)), structs)


def _lists(parts: list) -> pa.Array:
    return lists(np.concatenate(parts) if parts else np.zeros(0), [len(x) for x in parts], pa.int32())


def _whole(encode, text: bool):
    def emit(batches):
        for found in encode(batches):
            columns = {
                "doc_id": found.doc_id, "ids": lists(found.ids, np.diff(found.cut), pa.int32()), "decoded": pa.array(found.decoded, pa.string()),
                "exact": found.exact(), "samples": found.samples("ids", _lists),
            }
            if not text:
                del columns["decoded"]
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return emit


def _sha(ids: np.ndarray) -> str:
    return hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()


def _digested(encode):
    def emit(batches):
        for found in encode(batches):
            hashes = [_sha(found.ids[a:b]) for a, b in zip(found.cut[:-1], found.cut[1:])]
            samples = found.samples("ids_sha256", lambda drawn: pa.array([_sha(x) for x in drawn], pa.string()))
            yield pa.RecordBatch.from_arrays(
                [found.doc_id, pa.array(np.diff(found.cut)), pa.array(hashes, pa.string()), found.exact(), samples],
                names=["doc_id", "n_tokens", "ids_sha256", "round_trip", "samples"],
            )

    return emit


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _model(path: str) -> bytes:
    with open(path, "rb") as file:  # on the driver; tasks get its bytes
        return file.read()


def encoded(
    docs: DataFrame, model: str = MODEL, k: int = SAMPLES, seed: int = SEED, text: bool = True, kept: int = KEPT, at_once: int = AT_ONCE,
    bits: int = BITS,
) -> DataFrame:
    """``ENCODED`` for every row of ``docs`` (doc_id, text, ...).

    ``kept``, ``at_once`` and ``bits`` bound a worker's memory and change nothing in the result.
    ``ids`` are the model's, ``decoded`` is their text again (``exact``: the same; the text itself is left out
    without ``text``), and ``samples`` are up to ``k`` different
    segmentations drawn without replacement: their log probability, perturbed value and probability of
    inclusion (given the threshold), the largest value first.

    * Null or empty text: no ids, decoded to the empty text, and one sample, empty.
    * Fewer than ``k`` segmentations: all of them, with inclusion 1 (but for those less likely than 1e-15,
      which doubles don't tell from none).
    * Null doc_id: a key of its own, the same for all such rows; rows that repeat a doc_id and text get
      the same samples.  Other columns are ignored; an empty table gives no rows.
    """
    return _texts(docs).mapInArrow(_whole(_encoder(_model(model), k, seed, kept, at_once, bits), text), ENCODED if text else IDS)


def digest(docs: DataFrame, model: str = MODEL, k: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """``encoded`` with SHA-256 (of little-endian 32-bit ids) for ids, and whether the round trip is exact."""
    return _texts(docs).mapInArrow(_digested(_encoder(_model(model), k, seed)), DIGEST)


def decoded(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of (doc_id, ids, ...); null ids give a null text."""
    proto = _model(model)

    def decode(batches):
        processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            texts = [None if x is None else processor.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(decode, "doc_id long, text string")
