"""Substring dedup by collinear chaining: fuzzy passages that repeat an earlier document's.

1. Seeds: winnowed hashes of K words; any K + WINDOW - 1 equal words share one.  Words said
   over and over, up to PERIOD in turn, are one seed a run, with the run's length.  Each
   winnowed seed also makes a pair with the first one that lies PAIR words on, whatever
   stands between: who holds a pair holds both ends of the same passage.
2. Matches: a row is matched with the least document that holds its seed (a run with the
   longest one of an earlier document), in the batch where the batch has an earlier one,
   else among all: one or two matches a row, however many documents hold a seed.
3. Chains: matches of two documents that go on at the same offset are fragments;
   fragments in order in both texts are chained for the greatest matched length less a
   linear gap cost, by range maxima in a Fenwick tree over those that end within MAX_GAP.
4. Alignment: the words of a chain and of its margins are fetched in blocks of BLOCK
   words (each block of a document once, however many chains need it), runs are compared
   and gaps aligned word by word and the ends extended; passages of MIN_WORDS words and IDENTITY stay.
5. What is left: stretches in which every seed is known but that no passage covers may
   repeat a document that is no seed's least one.  All their runs of MIN_WORDS words are
   looked up in all texts; they are matched with their least holder and go through 3 and 4.

So every exact repeat of MIN_WORDS words in a row is found, whoever else holds parts of it;
fuzzy ones are found where a chain of seeds of one document pair spans MIN_CORE words.

Defined results: null, empty and short texts repeat nothing; the document of the least id
keeps a passage and later ones lose it; repeats within one document are left alone;
where ids are null or repeated, rows are numbered as they are stored and the number
takes the id's place in the order; a very long text is read whole, as a slice of its own;
other columns are kept by cut(), whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from understory.llm import textkernel as tk
from understory.llm.blocks import groups
from understory.llm.common import fresh, keyed, map_arrow, saved

K = 6
WINDOW = 8
#: Words from the beginning of a pair's first seed to the end of its second, at least.
PAIR = 30
#: Places within which seeds that come again are a run.
PERIOD = 8
#: A passage has this many words, this share of them equal.
MIN_WORDS = 50
IDENTITY = 0.8
#: Words a chain of seeds spans at least; the alignment may extend it by MARGIN on both sides.
MIN_CORE = 14
MARGIN = 64
#: Words of the seeds of an exact passage that may lie outside of its first and last one.
LOOSE = WINDOW - 1 + PERIOD
#: Cost of a word of gap in either text, and the longest gap that is bridged.  The
#: alignment takes chains apart where a gap doesn't align.
GAP_COST = 0.04
MAX_GAP = 128
BLOCK = 64
#: Blocks whose numbers are broadcast at most (4 bytes each, and 8 a document).
BROADCAST_BLOCKS = 1_000_000
#: Longs of the bit set of wanted windows at most, as a power of two (8 MB).
BIT_POWER = 20
_LOW = np.uint64((1 << 20) - 1)


def winnow(hashes: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the least hash of every window of consecutive hashes within each text.

    Hashes that come again within PERIOD places (words said over and over, singly or a
    few in turn) are passed over: one of them could be a large share of all seeds.  Their
    runs have seeds of their own, from periods().
    """
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    at = np.arange(n, dtype=np.uint64)
    again = np.zeros(n, bool)
    for d in range(1, min(PERIOD, n - 1) + 1):
        same = hashes[d:] == hashes[:-d]
        again[d:] |= same
        again[:-d] |= same
    value = (np.where(again, ~_LOW, hashes & ~_LOW)) | (at & _LOW)
    width = 1
    while width * 2 <= window:
        value = np.minimum(value[:-width], value[width:])
        width *= 2
    if width < window:
        rest = window - width
        value = np.minimum(value[: len(value) - rest], value[rest:])
    begins = np.arange(len(value))
    text = np.searchsorted(bounds, begins, side="right") - 1
    inside = begins + window <= bounds[text + 1]
    begins, value = begins[inside], value[inside]
    chosen = begins + (((value & _LOW).astype(np.int64) - begins) & int(_LOW))
    if len(chosen) > 1:
        chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
    return chosen[~again[chosen]]


def periods(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, seed, words, period) of the runs in which shingles come again at a distance of up to PERIOD.

    A run has one seed, of the least shingle of its cycle and of the period; its place is
    where that shingle first stands, its words those from there to the run's end.
    """
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, seeds, words, kinds = [], [], [], []
    known: dict[int, np.ndarray] = {}
    for d in range(1, min(PERIOD, len(hashes) - 1) + 1):
        same = np.zeros(len(hashes) + 1, bool)  # the last one ends all runs
        same[: len(hashes) - d] = (hashes[d:] == hashes[:-d]) & (text[d:] == text[:-d])
        for e, other in known.items():
            if d % e == 0:
                same &= ~other
        known[d] = same
        step = np.diff(same.astype(np.int8), prepend=0)
        first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if len(first):
            least = hashes[first[:, None] + np.arange(d)].argmin(axis=1)
            at.append(first + least)
            seeds.append(tk.mix(hashes[first + least] + np.uint64(d)))
            words.append(end + d - 1 + K - first - least)
            kinds.append(np.full(len(first), d))
    if not at:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    return np.concatenate(at), np.concatenate(seeds), np.concatenate(words), np.concatenate(kinds)


def seed_pairs(hashes: np.ndarray, chosen: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, seed, words) of each chosen shingle with the first chosen one that makes PAIR words or more; words between them are free."""
    text = np.searchsorted(bounds, chosen, side="right") - 1
    to = np.searchsorted(chosen, chosen + PAIR - K)
    inside = to < len(chosen)
    inside[inside] = text[to[inside]] == text[inside]
    at, end = chosen[inside], chosen[to[inside]]
    return at, tk.mix(hashes[at] + (hashes[end] ^ (hashes[end] >> np.uint64(7))) * np.uint64(3)), end + K - at


SEEDS = "seed long, key long, at int, n int, period byte, first long, first_at int"
MATCHES = "key long, first long, at int, first_at int, n int"


def _match_batch(key, first, at, first_at, n) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((key, first, at, first_at, n), kinds, strict=True)], names=["key", "first", "at", "first_at", "n"])


def _two(key, first, at, first_at, n, first_n) -> tuple[np.ndarray, ...]:
    """Matches of K words: one a seed, and both ends of a pair of seeds."""
    pair = n > K
    both = lambda a, b: np.concatenate([a, b[pair]])
    return both(key, key), both(first, first), both(at, at + n - K), both(first_at, first_at + first_n - K), np.full(len(key) + int(pair.sum()), K)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of n words each; those of runs have a period, others 0.

    Within a batch a seed goes on with its least document only; rows of later ones are
    matched here (first, first_at), so a seed that a third of all texts hold is a row a
    batch, not a row a text.
    """
    for batch in batches:
        keys = batch.column("key").to_numpy()
        rows: list[tuple] = []
        for begin, _, raw, offsets in tk.slices(batch.column("text")):
            found = tk.words(raw, offsets)
            hashes, bounds = tk.shingles(found, K)
            chosen = winnow(hashes, bounds)
            pairs, runs = seed_pairs(hashes, chosen, bounds), periods(hashes, bounds)
            place = np.concatenate([chosen, pairs[0], runs[0]])
            text = np.searchsorted(bounds, place, side="right") - 1
            n = np.concatenate([np.full(len(chosen), K), pairs[2], runs[2]]).astype(np.int32)
            period = np.concatenate([np.zeros(len(chosen) + len(pairs[0]), np.int8), runs[3].astype(np.int8)])
            long = found.counts[text] >= MIN_WORDS
            rows.append(tuple(c[long] for c in (np.concatenate([hashes[chosen], pairs[1], runs[1]]), keys[begin + text], (place - bounds[text]).astype(np.int32), n, period)))
        seed, key, at, n, period = (np.concatenate(c) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.uint64),) * 5
        if not len(seed):
            continue
        order = np.lexsort((at, key, seed))
        seed, key, at, n, period = seed[order], key[order], at[order], n[order], period[order]
        new = np.concatenate([[True], seed[1:] != seed[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(seed)), 0))
        goes_on = key == key[start]
        runs = np.flatnonzero((period > 0) & ~goes_on)
        if len(runs):  # of a run, also those that are longer than the ones of documents before
            longest, mine = _Longest(), np.flatnonzero(period)
            found = []
            for i, r in zip(mine.tolist(), zip(*(x[mine].tolist() for x in (seed, key, at, n, period)), strict=True), strict=True):
                goes_on[i] |= longest.adds(*r)
                if not goes_on[i]:
                    found += longest.matches(*r)
            if found:
                yield _passed(*zip(*found, strict=True))
        here = np.flatnonzero(~goes_on & (period == 0))
        if len(here):
            of = start[here]
            yield _passed(*_two(key[here], key[of], at[here], at[of], n[here], n[of]))
        some = np.flatnonzero(goes_on)
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(seed[some].view(np.int64)), pa.array(key[some]), pa.array(at[some]), pa.array(n[some]), pa.array(period[some]), none, none.cast(pa.int32())],
            names=["seed", "key", "at", "n", "period", "first", "first_at"],
        )


def _passed(key, first, at, first_at, n) -> pa.RecordBatch:
    """Matches in the columns of seeds; they go by their document."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int8(), pa.int64(), pa.int32())
    columns = (key, key, at, n, np.zeros(len(key), np.int8), first, first_at)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["seed", "key", "at", "n", "period", "first", "first_at"])


class _Longest:
    """Runs of one seed as they stream by in the order of documents, each held against the longest one of the documents before."""

    def __init__(self):
        self.seed = self.key = None

    def adds(self, seed: int, key: int, at: int, n: int, period: int) -> bool:
        """Take up a run; whether it is longer than all of the documents before."""
        if seed != self.seed:
            self.seed, self.key, self.before, self.upto = seed, key, (0, 0, 0), (0, 0, 0)
        if key != self.key:
            self.key, self.before = key, self.upto
        if n > self.upto[0]:
            self.upto = (n, key, at)
        return n > self.before[0]

    def matches(self, seed: int, key: int, at: int, n: int, period: int) -> Iterator[tuple[int, int, int, int, int]]:
        """Matches of the run just taken up: in tiles, whole periods apart, where it is longer than the other."""
        length, other, place = self.before
        if length:
            last = max(n - length, 0)
            last += -last % period if n - last - (-last % period) >= MIN_WORDS else -(last % period)
            step = length - length % period
            for to in [*(range(0, last, step) if length >= MIN_WORDS else [0] * (last > 0)), last]:
                yield key, other, at + to, place, min(length, n - to)


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's match with the first row of its seed, and matches made before; rows come sorted by seed, key, at."""
    last, longest = None, _Longest()
    for batch in batches:
        made = batch.column("first").is_valid()
        if made.true_count:
            yield batch.filter(made).select(["key", "first", "at", "first_at", "n"])
            batch = batch.filter(made.to_numpy(zero_copy_only=False) == 0) if made.true_count < batch.num_rows else batch.slice(0, 0)
        if not batch.num_rows:
            continue
        seed, key, at, n, period = (batch.column(i).to_numpy() for i in range(5))
        new = np.concatenate([[True], seed[1:] != seed[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(seed)), 0))
        first, first_at, first_n = key[start], at[start], n[start]
        if last is not None and last[0] == seed[0]:
            lead = start == 0
            first, first_at, first_n = (np.where(lead, v, x) for v, x in zip(last[1:], (first, first_at, first_n), strict=True))
        last = (seed[-1], first[-1], first_at[-1], first_n[-1])
        rows = np.flatnonzero((key != first) & (period == 0))
        if len(rows):
            yield _match_batch(*_two(key[rows], first[rows], at[rows], first_at[rows], n[rows], first_n[rows]))
        rows, found = np.flatnonzero(period), []
        for r in zip(*(x[rows].tolist() for x in (seed, key, at, n, period)), strict=True):
            longest.adds(*r)
            found += longest.matches(*r)
        if found:
            yield _match_batch(*zip(*found, strict=True))


class Maxima:
    """A Fenwick tree of maxima over places 1..n whose values can be put in and taken out."""

    NONE = (float("-inf"), -1)

    def __init__(self, n: int):
        self.own, self.tree = [self.NONE] * (n + 1), [self.NONE] * (n + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        self.own[at] = value
        while at < len(self.tree):
            if self.tree[at] < value:
                self.tree[at] = value
            at += at & -at

    def take(self, at: int) -> None:
        gone, self.own[at] = self.own[at], self.NONE
        while at < len(self.tree):
            if self.tree[at] == gone:
                best, low, step = self.own[at], at & -at, 1
                while step < low:
                    best = max(best, self.tree[at - step])
                    step *= 2
                self.tree[at] = best
            at += at & -at

    def best(self, first: int, last: int) -> tuple[float, int]:
        """The greatest (value, index) of the places first..last."""
        found = self.NONE
        while last >= first:
            low = last & -last
            if last - low + 1 >= first:
                found, last = max(found, self.tree[last]), last - low
            else:
                found, last = max(found, self.own[last]), last - 1
        return found


def chain(fragments: list[tuple[int, int, int]]) -> list[list[int]]:
    """Chains of fragments (at, first_at, length), each a list of indices in order.

    Chains maximise matched words less GAP_COST for each word between fragments in
    either text; gaps over MAX_GAP are not bridged.  Each fragment is in one chain.
    Fragments are taken up by their beginning; the tree holds those that end within
    MAX_GAP before it, by their end in the other text, so the best that may come before
    is one range query.
    """
    if len(fragments) == 1:
        return [[0]]
    order = sorted(range(len(fragments)), key=lambda i: fragments[i])
    ends = sorted((b + n, i) for i, (_, b, n) in enumerate(fragments))
    place = {i: at for at, (_, i) in enumerate(ends, 1)}
    waiting = sorted(order, key=lambda i: fragments[i][0] + fragments[i][2])
    tree, left, done = Maxima(len(fragments)), 0, 0
    score, before = [0.0] * len(fragments), [-1] * len(fragments)
    for i in order:
        a, b, n = fragments[i]
        while done < len(waiting) and (x := fragments[waiting[done]])[0] + x[2] <= a:
            j = waiting[done]
            tree.put(place[j], (score[j] + GAP_COST * (x[0] + x[1] + 2 * x[2]), j))
            done += 1
        while left < done and (x := fragments[waiting[left]])[0] + x[2] < a - MAX_GAP:
            tree.take(place[waiting[left]])
            left += 1
        value, j = tree.best(bisect_left(ends, (b - MAX_GAP,)) + 1, bisect_left(ends, (b + 1,)))
        value -= GAP_COST * (a + b)
        score[i], before[i] = (n + value, j) if value > 0 else (float(n), -1)
    chains, used = [], set()
    for i in sorted(order, key=lambda i: (-score[i], i)):
        path = []
        while i >= 0 and i not in used:
            used.add(i)
            path.append(i)
            i = before[i]
        if path:
            chains.append(path[::-1])
    return chains


def _disjoint(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments without small overlaps of the ones at other offsets: the later gives way.

    One that would lose most of its words stays whole where it can be a chain of its own.
    """
    out: list[tuple[int, int, int]] = []
    for a, b, n in fragments:
        if out:
            x, y, m = out[-1]
            over = max(x + m - a, 0)
            if a - b != x - y and over and (n < MIN_CORE or over < n / 2):
                a, b, n = a + over, b + over, n - over
        if n > 0:
            out.append((a, b, n))
    return out


def _stretches(at: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of a text in which no seed is new that may hold an exact passage."""
    order = np.argsort(at, kind="stable")
    at, end = at[order], np.maximum.accumulate((at + n)[order])
    heads = np.flatnonzero(np.concatenate([[True], at[1:] > end[:-1] + WINDOW + PERIOD]))
    tails = np.concatenate([heads[1:], [len(at)]]) - 1
    return [(x, y) for x, y in zip(at[heads].tolist(), end[tails].tolist(), strict=True) if y - x >= MIN_WORDS - 2 * LOOSE]


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of each (key, first), and stretches (first is null); rows come sorted by key."""
    out: list[tuple] = []
    for group in groups(batches, ["key"]):
        key, first, at, first_at, n = (group.column(i).to_numpy().astype(np.int64) for i in range(5))
        order = np.lexsort((at, at - first_at, first))
        first, at, first_at, n = first[order], at[order], first_at[order], n[order]
        # fragments: matches at one offset that go on before the ones so far are WINDOW behind
        new = np.concatenate([[True], (np.diff(first) != 0) | (np.diff(at - first_at) != 0)])
        line = np.cumsum(new) << 32
        end = np.maximum.accumulate(at + n + line) - line
        heads = np.flatnonzero(new | np.concatenate([[True], at[1:] > end[:-1] + WINDOW]))
        tails = np.concatenate([heads[1:], [len(at)]]) - 1
        of, a, b, size = first[heads], at[heads], first_at[heads], end[tails] - at[heads]
        order = np.lexsort((b, a, of))
        of, a, b, size = of[order], a[order], b[order], size[order]
        for x, y in _stretches(at, n):
            out.append((int(key[0]), None, x, y, 0, 0, [], [], []))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]]).tolist()
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if (a[lo:hi] + size[lo:hi]).max() - a[lo] < MIN_CORE:
                continue
            runs = _disjoint(list(zip(a[lo:hi].tolist(), b[lo:hi].tolist(), size[lo:hi].tolist(), strict=True)))
            for path in chain(runs):
                x, y, _ = runs[path[0]]
                u, v, m = runs[path[-1]]
                if u + m - x >= MIN_CORE:
                    out.append((int(key[0]), int(of[lo]), x, u + m, y, v + m, [runs[i][0] for i in path], [runs[i][1] for i in path], [runs[i][2] for i in path]))
        if len(out) >= 5000:
            yield _chain_batch(out)
            out = []
    if out:
        yield _chain_batch(out)


_CHAIN_SCHEMA = pa.schema(
    [("key", pa.int64()), ("first", pa.int64()), *((n, pa.int32()) for n in ("start", "end", "first_start", "first_end")), *((n, pa.list_(pa.int32())) for n in ("runs", "first_runs", "lengths"))]
)
CHAINS = "key long, first long, start int, end int, first_start int, first_end int, runs array<int>, first_runs array<int>, lengths array<int>"


def _chain_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHAIN_SCHEMA, strict=True)], schema=_CHAIN_SCHEMA)


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked blocks of each text as 32-bit word hashes."""
    for batch in batches:
        keys, asked = batch.column("key").to_pylist(), batch.column("blocks").to_pylist()
        for first, end, raw, offsets in tk.slices(batch.column("text")):
            found = tk.words(raw, offsets)
            short = found.hashes.astype(np.uint32)
            rows = [
                (keys[i], b, short[lo + b * BLOCK : min(hi, lo + (b + 1) * BLOCK)].tobytes())
                for i, lo, hi in zip(range(first, end), found.bounds[:-1].tolist(), found.bounds[1:].tolist(), strict=True)
                for b in asked[i]
                if lo + b * BLOCK < hi
            ]
            if rows:
                k, b, w = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(b, pa.int32()), pa.array(w, pa.binary())], names=["of", "block", "words"])


def matched(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words of the best alignment of two short runs of words."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    if not n:
        return head
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        step = row.copy()
        step[1:] = np.maximum(row[1:], row[:-1] + (b == x))
        row = np.maximum.accumulate(step)
    return head + tail + int(row[-1])


def extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words, matches) by which two runs agree from their beginnings, over single wrong words."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    low = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > 6)
    reach = int(low[0]) if len(low) else n
    if not reach:
        return 0, 0
    best = int(score[:reach].argmax())
    return (best + 1, int(same[: best + 1].sum())) if score[best] > 0 else (0, 0)


def equal_runs(a: np.ndarray, b: np.ndarray, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The stretches of equal words along the diagonals of runs (at, first_at, length)."""
    out = []
    for x, y, n in runs:
        u, v = a[x : x + n], b[y : y + n]
        n = min(len(u), len(v))
        same = np.zeros(n + 2, np.int8)
        same[1:-1] = u[:n] == v[:n]
        step = np.diff(same)
        out += [(x + i, y + i, j - i) for i, j in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)]
    return out


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of chains from their blocks; rows come sorted by chain, side, block."""
    out: list[tuple] = []
    for group in groups(batches, ["chain"]):
        side, block = group.column("side").to_numpy(), group.column("block").to_numpy()
        words = group.column("words").to_pylist()
        both = []
        for s in (0, 1):
            mine = np.flatnonzero(side == s)
            both.append((int(block[mine[0]]) * BLOCK, np.frombuffer(b"".join(words[i] for i in mine), np.uint32)) if len(mine) else (0, np.zeros(0, np.uint32)))
        (base, a), (first_base, b) = both
        row = group.slice(0, 1).to_pylist()[0]
        runs = [(x - base, y - first_base, n) for x, y, n in zip(row["runs"], row["first_runs"], row["lengths"], strict=True)]
        runs = equal_runs(a, b, runs)
        if not runs:
            continue
        parts, same = [[0, 0, runs[0][2]]], 0
        for i, ((x, y, n), (u, v, m)) in enumerate(zip(runs, runs[1:], strict=False), 1):
            gap = max(u - x - n, v - y - n)
            same = matched(a[x + n : u], b[y + n : v]) if u > x + n and v > y + n else 0
            if gap > 8 and same < gap / 2:
                parts.append([i, i, m])
            else:
                parts[-1][1] = i
                parts[-1][2] += same + m
        for head, tail, same in parts:
            x, y, _ = runs[head]
            u, v, n = runs[tail]
            left, left_same = extend(a[max(0, x - MARGIN) : x][::-1], b[max(0, y - MARGIN) : y][::-1])
            right, right_same = extend(a[u + n : u + n + MARGIN], b[v + n : v + n + MARGIN])
            length = u + n + right - (x - left)
            other = v + n + right - (y - left)
            share = (same + left_same + right_same) / max(length, other, 1)
            if length >= MIN_WORDS and share >= IDENTITY:
                out.append((row["key"], row["first"], base + x - left, base + u + n + right, first_base + y - left, first_base + v + n + right, min(1.0, share)))
        if len(out) >= 20_000:
            yield _passage_batch(out)
            out = []
    if out:
        yield _passage_batch(out)


PASSAGES = "key long, first long, start int, end int, first_start int, first_end int, identity double"


def _passage_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    names = ["key", "first", "start", "end", "first_start", "first_end", "identity"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _chained(matches: DataFrame) -> DataFrame:
    """Chains of matches, numbered, and stretches, as a stored table."""
    ordered = matches.repartition("key").sortWithinPartitions("key", "first", "at", "first_at")
    return saved(map_arrow(ordered, _chains, CHAINS).withColumn("chain", F.monotonically_increasing_id()), "chains")


def _aligned(texts: DataFrame, chains: DataFrame) -> DataFrame:
    """PASSAGES of chains."""
    spans = chains.select(
        "chain",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("key").alias("of"), F.col("start").alias("a"), F.col("end").alias("b")),
                F.struct(F.lit(1).alias("side"), F.col("first").alias("of"), F.col("first_start").alias("a"), F.col("first_end").alias("b")),
            )
        ),
    )
    low, high = F.greatest(F.col("a") - MARGIN, F.lit(0)), F.col("b") + MARGIN - 1
    wanted = spans.select("chain", "side", "of", F.explode(F.sequence((low / BLOCK).cast("int"), (high / BLOCK).cast("int"))).alias("block"))
    asked = saved(wanted.select("of", "block").distinct().groupBy("of").agg(F.collect_list("block").alias("blocks")), "blocks")
    total = asked.agg(F.sum(F.size("blocks"))).first()[0] or 0
    few = F.broadcast(asked) if total <= BROADCAST_BLOCKS else asked
    words = map_arrow(texts.join(few, F.col("key") == F.col("of")).select("key", "text", "blocks"), _word_blocks, "of long, block int, words binary")
    fetched = wanted.join(words, ["of", "block"])
    # what a chain is goes with one row of it: its first block
    at_first = chains.select("chain", F.lit(0).alias("side"), (F.greatest(F.col("start") - MARGIN, F.lit(0)) / BLOCK).cast("int").alias("block"), "key", "first", "runs", "first_runs", "lengths")
    ready = fetched.join(at_first, ["chain", "side", "block"], "left").select("chain", "side", "block", "words", "key", "first", "runs", "first_runs", "lengths")
    ready = ready.repartition("chain").sortWithinPartitions("chain", "side", "block")
    return map_arrow(ready, _align, PASSAGES)


def _windows(found: tk.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place) of all runs of MIN_WORDS words of consecutive texts."""
    runs = np.maximum(found.counts - MIN_WORDS + 1, 0)
    text = np.repeat(np.arange(len(runs)), runs)
    at = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    first = found.bounds[:-1][text] + at
    return tk.spans(found, first, first + MIN_WORDS), text, at


_WINDOWS = "seed long, key long, at int"


def _window_batch(hashes: np.ndarray, keys: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(keys), pa.array(at.astype(np.int32))], names=["seed", "key", "at"])


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of MIN_WORDS words of the stretches of each text that no found passage holds."""
    for batch in batches:
        keys, stretches, spans = batch.column("key").to_numpy(), batch.column("stretches").to_pylist(), batch.column("spans").to_pylist()
        for begin, end, raw, offsets in tk.slices(batch.column("text")):
            hashes, text, at = _windows(tk.words(raw, offsets))
            ask = np.zeros(len(hashes), bool)
            bounds = np.searchsorted(text, np.arange(end - begin + 1))
            for i in range(begin, end):
                mine = ask[bounds[i - begin] : bounds[i - begin + 1]]
                for s in stretches[i]:
                    mine[max(0, s["start"] - LOOSE) : max(0, s["end"] + LOOSE - MIN_WORDS + 1)] = True
                for s in spans[i] or ():
                    mine[s["start"] : max(s["start"], s["end"] - MIN_WORDS + 1)] = False
            if ask.any():
                yield _window_batch(hashes[ask], keys[begin + text[ask]], at[ask])


def _bits(wanted: DataFrame, count: int) -> np.ndarray:
    """A bit set of the wanted hashes, 64 bits for each at least up to 2 ** BIT_POWER longs."""
    power = int(min(BIT_POWER, max(10, np.ceil(np.log2(max(count, 1))))))
    place = F.shiftrightunsigned("seed", 64 - power).cast("int").alias("place")
    rows = wanted.select(place, F.expr("shiftleft(1L, cast(seed & 63 AS int))").alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << power, np.int64)
    for row in rows.toLocalIterator():  # 2 ** power rows at most
        out[row[0]] = row[1]
    return out.view(np.uint64)


def _holders(bits: np.ndarray):
    """The first of each text's runs of MIN_WORDS words that the bit set lets through."""
    shift = np.uint64(64 - int(np.log2(len(bits))))

    def run(texts: pa.Array, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        for begin, _, raw, offsets in tk.slices(texts):
            hashes, text, at = _windows(tk.words(raw, offsets))
            some = np.flatnonzero((bits[(hashes >> shift).astype(np.int64)] >> (hashes & np.uint64(63))) & np.uint64(1))
            if len(some):
                hashes, text, at = hashes[some], text[some], at[some]
                order = np.lexsort((at, text, hashes))
                hashes, text, at = hashes[order], text[order], at[order]
                one = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])
                yield _window_batch(hashes[one], keys[begin + text[one]], at[one])

    return run


def _exact(texts: DataFrame, stretches: DataFrame, found: DataFrame) -> DataFrame | None:
    """Matches of the runs of MIN_WORDS words in stretches beyond found passages with the first document that holds them; None without any."""
    spans = found.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_s")).select("key", F.expr(_merge_spans("_s")).alias("spans"))
    left = stretches.select("key", "start", "end").join(spans, "key", "left").where("spans IS NULL OR NOT exists(spans, s -> s.start <= start AND s.end >= end)")
    left = left.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("stretches"), F.first("spans").alias("spans"))
    left = saved(left.withColumnRenamed("key", "of"), "stretches")
    n = left.agg(F.sum(F.size("stretches") + F.greatest(F.size("spans"), F.lit(0)) + 1)).first()[0]
    if not n:
        return None
    rows = texts.join(F.broadcast(left) if n <= BROADCAST_BLOCKS // 4 else left, F.col("key") == F.col("of")).select("key", "text", "stretches", "spans")
    wanted = saved(map_arrow(rows, _wanted, _WINDOWS), "wanted")
    count = wanted.count()
    if not count:
        return None
    bits = texts.sparkSession.sparkContext.broadcast(_bits(wanted, count))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders = _holders(bits.value)
        for batch in batches:
            yield from holders(batch.column("text"), batch.column("key").to_numpy())

    holders = map_arrow(texts, scan, _WINDOWS)
    firsts = holders.groupBy("seed").agg(F.min("key").alias("first"), F.min_by("at", "key").alias("first_at"))
    matched = wanted.join(firsts, "seed").where("key > first")
    return matched.select("key", "first", "at", "first_at", F.lit(MIN_WORDS).alias("n"))


def passages(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, first, start, end, first_start, first_end, identity): passages of docs (key, text) that an earlier one holds.

    Ranges are in words.  A document's passages may overlap where several earlier
    documents hold parts of them.
    """
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    seeds = map_arrow(texts, _seeds, SEEDS)
    ordered = seeds.repartition(F.coalesce("first", "seed"), F.when(F.col("first").isNotNull(), F.col("key"))).sortWithinPartitions("seed", "key", "at")
    made = _chained(map_arrow(ordered, _matches, MATCHES))
    found = saved(_aligned(texts, made.where("first IS NOT NULL")), "passages")
    more = _exact(texts, made.where("first IS NULL"), found)
    return found if more is None else found.unionByName(_aligned(texts, _chained(more).where("first IS NOT NULL")))


def _merge_spans(spans: str) -> str:
    """SQL that merges an ordered array of (start, end) where they touch."""
    return f"""
        aggregate({spans}, cast(array() AS array<struct<start: int, end: int>>), (done, s) ->
          if(size(done) > 0 AND done[size(done) - 1].end >= s.start,
             concat(slice(done, 1, size(done) - 1), array(struct(done[size(done) - 1].start AS start, greatest(done[size(done) - 1].end, s.end) AS end))),
             concat(done, array(struct(s.start AS start, s.end AS end)))))"""


def repeats(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, spans, firsts, identity) of the documents of docs (key, text) with repeated passages.

    spans: word ranges, merged and ordered; firsts: the earlier documents' keys; as many
    as a document has passages at most.
    """
    grouped = passages(docs, key, text).groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_s"), F.array_sort(F.collect_set("first")).alias("firsts"), F.min("identity").alias("identity")
    )
    return grouped.withColumn("spans", F.expr(_merge_spans("_s"))).drop("_s")


def _cut(batches: Iterator[pa.RecordBatch], text_at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(text_at).to_pylist(), batch.column(len(names)).to_pylist()
        for i, cuts in enumerate(spans):
            if not cuts or texts[i] is None:
                continue
            raw = texts[i].encode()
            found = tk.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            parts, at = [], 0
            for c in cuts:
                parts.append(raw[at : found.starts[c["start"]]])
                at = int(found.starts[c["end"]]) if c["end"] < len(found.starts) else int(found.ends[-1])
            parts.append(raw[at:])
            texts[i] = b"".join(parts).decode("utf-8", "replace")
        columns = [pa.array(texts, pa.string()) if j == text_at else batch.column(j) for j in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def cut(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs without passages that an earlier document holds; texts left without words go, all columns stay."""
    rows, key = keyed(docs, id_col)
    of, spans = fresh(rows, "_of", "_spans")
    found = saved(repeats(rows, key).select(F.col("key").alias(of), F.col("spans").alias(spans)), "cuts")
    small = (found.agg(F.sum(F.size(spans))).first()[0] or 0) <= BROADCAST_BLOCKS
    joined = rows.join(F.broadcast(found) if small else found, F.col(key) == F.col(of), "left").select(*docs.columns, spans)
    changed = joined.where(F.col(spans).isNotNull())
    names, at = list(docs.columns), docs.columns.index("text")
    trimmed = map_arrow(changed, lambda batches: _cut(batches, at, names), docs.schema)
    trimmed = trimmed.where(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    if "n_chars" in names:
        trimmed = trimmed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.where(F.col(spans).isNull()).select(*names).unionByName(trimmed.select(*names))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: passages that an earlier document holds are cut out."""
    return cut(docs)


def op2_passage_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_repeated, spans, firsts, n_later of each row of documents.

    n_repeated: words of passages that earlier documents hold; firsts: those documents;
    n_later: later documents that repeat a passage of this one.
    """
    docs, key = keyed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = saved(repeats(docs, key), "repeats")
    later = found.select(F.explode("firsts").alias("key")).groupBy("key").agg(F.count("*").alias("n_later"))
    rows = docs.select("doc_id", F.col(key).alias("key")).join(found, "key", "left").join(later, "key", "left")
    return rows.select(
        "doc_id",
        F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"), F.lit(0).cast("long")).alias("n_repeated"),
        "spans",
        "firsts",
        F.coalesce("n_later", F.lit(0).cast("long")).alias("n_later"),
    )
