"""Suffix order and common prefixes of a string by external induced sorting.

The suffixes that are smaller than their left neighbour but follow a larger one (the
leftmost small ones, LMS) are sorted first: the substrings between them get names in
their order, the names are written as digits of a small alphabet, and the suffixes of
that string are sorted by the same method, recursively. All others are induced: one
scan upwards for the suffixes larger than their right neighbour (L), one downwards for
the smaller ones (S). A scan takes suffix tuples (position, common prefix with the one
before) in order from a priority queue over the first symbol, and puts the tuple of
the position to the left into the queue of that position's symbol. Within one symbol
tuples come in order, so a queue is a list of blocks for each symbol; blocks go to
disk beyond a bound on memory. The common prefix of two tuples put into one queue is
one more than the least of those passed between them.

Everything that is as long as the string lies in files: the text, its types, the LMS
positions, their names, the sorted LMS suffixes, and the queues. In memory are blocks of
BLOCK tuples, QUEUE_TUPLES of each queue, the LMS substrings that begin with one pair
of symbols (in parts of NAMING, if no single pair has more), and counts for each symbol.
The recursion ends where all names differ, or with a string of at most BASE_SYMBOLS names,
which is sorted by prefix doubling in memory. That bound doesn't depend on the string.

Common prefixes count up to `depth` symbols, and suffixes that agree in as many are in
no particular order, which is all that finding repeats of a given length asks for.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 16
#: Tuples that a queue holds in memory.
QUEUE_TUPLES = 1 << 18
#: LMS substrings that are named at a time, about.
NAMING = 1 << 19
#: Names that may be sorted in memory, where the recursion ends.
BASE_SYMBOLS = 1 << 20
#: Bits of a digit that names are written in, at most.
DIGIT_BITS = 12
CHUNK = 1 << 20


class Space:
    """Files of one sort, gone when their arrays are; counts what went to disk."""

    def __init__(self, folder: str | None = None, memory: int = QUEUE_TUPLES, base: int = BASE_SYMBOLS):
        self.folder, self.memory, self.base = folder, memory, base
        self.spills = self.recursions = self.doublings = 0

    def array(self, n: int, kind) -> np.ndarray:
        kind = np.dtype(kind)
        with tempfile.TemporaryFile(dir=self.folder) as file:
            file.truncate(max(1, n) * kind.itemsize)
            return np.asarray(np.memmap(file, kind, "r+", shape=(max(1, n),)))[:n]


class DiskQueue:
    """A priority queue of (position, common prefix) tuples over small integer keys, first in first out within a key.

    Each block that is put is a run, sorted by key; in memory are QUEUE_TUPLES tuples of runs, which are merged into one run
    on disk when there are more. A key's tuples are the pieces of all runs in their order.
    """

    def __init__(self, position_type, symbols: int, space: Space):
        self.kinds = (np.dtype(position_type), np.dtype(np.uint16))
        self.symbols, self.space, self.held, self.file = symbols, space, 0, None
        self.runs: list[tuple] = []  # in memory: bounds of the keys, positions, prefixes
        self.spilled: list[tuple] = []  # on disk: bounds, place in the file

    def put(self, key: np.ndarray, position: np.ndarray, prefix: np.ndarray) -> None:
        """Tuples whose keys ascend."""
        self.runs.append((key[[0, -1]].tolist(), key, position.astype(self.kinds[0], copy=False), prefix))
        self.held += len(position)

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.space.folder)
        _, key, position, prefix = zip(*self.runs, strict=True)
        key = np.concatenate(key)
        order = np.argsort(key.astype(np.uint16 if self.symbols < 1 << 16 else np.uint32), kind="stable")
        bounds = np.append(0, np.cumsum(np.bincount(key, minlength=self.symbols)))
        at = self.file.seek(0, os.SEEK_END)
        self.file.write(np.concatenate(position)[order].tobytes() + np.concatenate(prefix)[order].tobytes())
        self.spilled.append((bounds, at, len(key)))
        self.runs, self.held = [], 0
        self.space.spills += 1

    def _pieces(self, key: int, run: int) -> list[tuple]:
        """(run, first tuple, one after the last) of a key, in order, from a run on."""
        out = []
        for r in range(run, len(self.spilled)):
            a, b = self.spilled[r][0][key : key + 2].tolist()
            out += [(r, c, min(c + BLOCK, b)) for c in range(a, b, BLOCK)]
        return out

    def _read(self, run: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        _, at, n = self.spilled[run]
        out = []
        for kind in self.kinds:
            self.file.seek(at + a * kind.itemsize)
            out.append(np.frombuffer(self.file.read((b - a) * kind.itemsize), kind))
            at += n * kind.itemsize
        return out[0], out[1]

    def _held(self, key: int, first: int) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for (low, high), keys, position, prefix in self.runs[first:]:
            if low <= key <= high:
                a, b = np.searchsorted(keys, (key, key + 1)).tolist()
                if a < b:
                    out.append((position[a:b], prefix[a:b]))
        return out

    @staticmethod
    def joined(some: list) -> tuple[np.ndarray, np.ndarray]:
        return some[0] if len(some) == 1 else (np.concatenate([p for p, _ in some]), np.concatenate([x for _, x in some]))

    def take(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The blocks of a key in order, also those that are put while it is being taken."""
        if self.held > self.space.memory:
            self._spill()
        some, n = [], 0
        for r, a, b in self._pieces(key, 0):
            some.append(self._read(r, a, b))
            n += b - a
            if n >= BLOCK:
                yield self.joined(some)
                some, n = [], 0
        seen = 0
        while True:
            # runs that came meanwhile count, too; nothing spills while a key is being taken
            some, seen = some + self._held(key, seen), len(self.runs)
            if not some:
                return
            yield self.joined(some)
            some = []

    def take_last(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The blocks of a key, the last first (each in its own order)."""
        some = self._held(key, 0)[::-1]
        n = sum(len(p) for p, _ in some)
        for r, a, b in reversed(self._pieces(key, 0)):
            if n >= BLOCK:
                yield self.joined(some[::-1])
                some, n = [], 0
            some.append(self._read(r, a, b))
            n += b - a
        if some:
            yield self.joined(some[::-1])

    def settle(self) -> None:
        """Brings what is held beyond the bound to disk."""
        if self.held > self.space.memory:
            self._spill()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Minima:
    """The least prefix that a scan has passed since a given step: a stack of suffix minima, at most `depth` long."""

    def __init__(self):
        self.at, self.value = np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def since(self, step: np.ndarray, now: int, most: int) -> np.ndarray:
        """Least value after each step and before now; `most` where there is none."""
        out = np.full(len(step), most, np.uint16)
        some = (step >= 0) & (step < now - 1)
        out[some] = self.value[np.searchsorted(self.at, step[some], side="right")]
        return out

    def add(self, first: int, values: np.ndarray) -> None:
        low = np.minimum.accumulate(values[::-1])[::-1]
        own = np.flatnonzero(np.append(low[1:] != low[:-1], True))
        keep = np.searchsorted(self.value, low[0], side="left")
        self.at, self.value = np.concatenate((self.at[:keep], own + first)), np.concatenate((self.value[:keep], low[own]))


def range_minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a[i]:b[i] + 1]) for each i, by a table of minima over powers of two."""
    if not len(a):
        return values[:0]
    n = b - a + 1
    level = np.frexp(n.astype(np.float64))[1] - 1
    rows = [values]
    for k in range(int(level.max())):
        half = 1 << k
        up = rows[-1].copy()
        up[:-half] = np.minimum(rows[-1][:-half], rows[-1][half:])
        rows.append(up)
    rows = np.stack(rows)
    return np.minimum(rows[level, a], rows[level, b + 1 - (1 << level)])


class Scan:
    """One direction of induction: takes blocks in order and queues the tuples of their left neighbours of one type."""

    def __init__(self, coded: np.ndarray, symbols: int, small: bool, depth: int, queue: DiskQueue):
        self.coded, self.small, self.depth, self.queue = coded, small, depth, queue
        self.step, self.minima, self.last = 0, Minima(), np.full(symbols, -1, np.int64)

    def feed(self, position: np.ndarray, prefix: np.ndarray) -> None:
        for a in range(0, len(position), BLOCK):
            self._feed(position[a : a + BLOCK], prefix[a : a + BLOCK])

    def _feed(self, position: np.ndarray, prefix: np.ndarray) -> None:
        left = position.astype(np.int64) - 1
        code = self.coded[np.maximum(left, 0)]
        chosen = np.flatnonzero(((code & 1) == self.small) & (left >= 0))
        if len(chosen):
            key = code[chosen] >> 1
            order = np.argsort(key, kind="stable")
            key, chosen = key[order].astype(np.int64), chosen[order]
            first = np.append(True, key[1:] != key[:-1])
            starts = np.flatnonzero(first)
            value = np.empty(len(key), np.uint16)
            # after another one of this block
            inner = np.flatnonzero(~first)
            value[inner] = range_minima(prefix, chosen[inner - 1] + 1, chosen[inner])
            # after one of an earlier block, or as the first of all
            heads = key[starts]
            before = self.last[heads]
            low = np.minimum.accumulate(prefix)[chosen[starts]]
            value[starts] = np.minimum(low, self.minima.since(before, self.step, self.depth))
            value = np.minimum(value + np.uint16(1), np.uint16(self.depth))
            value[starts[before < 0]] = 0
            ends = np.append(starts[1:], len(key))
            self.last[heads] = self.step + chosen[ends - 1]
            self.queue.put(key, left[chosen], value)
        self.minima.add(self.step, prefix)
        self.step += len(position)


def ranks_of(text: np.ndarray, lms: np.ndarray, length: np.ndarray, bits: int) -> np.ndarray:
    """Ranks of the substrings that begin at lms and have these lengths; equal ones have one rank.

    Ranks are indices of the first of a group in the sorted order. Each round packs the next symbols of what is still in
    doubt into one number; an ended substring sorts after a longer one, for its last symbol is of the larger type.
    """
    rank = np.zeros(len(lms), np.int64)
    per = 62 // bits
    end = (1 << bits) - 1
    doubt = np.arange(len(lms))
    offset = 0
    while len(doubt):
        at, size = lms[doubt] + offset, length[doubt] - offset
        key = np.zeros(len(doubt), np.int64)
        for i in range(per):
            symbol = text[np.minimum(at + i, len(text) - 1)].astype(np.int64)
            key = (key << bits) | np.where(i < size, symbol, end)
        order = np.lexsort((key, rank[doubt])) if offset else np.argsort(key, kind="stable")
        doubt, key = doubt[order], key[order]
        old = rank[doubt]
        new_group = np.append(True, old[1:] != old[:-1])
        new_rank = new_group | np.append(True, key[1:] != key[:-1])
        place = np.arange(len(doubt))
        group_at = np.maximum.accumulate(np.where(new_group, place, 0))
        rank_at = np.maximum.accumulate(np.where(new_rank, place, 0))
        rank[doubt] = old + rank_at - group_at
        offset += per
        run = np.cumsum(new_rank) - 1
        count = np.bincount(run)
        unfinished = np.bincount(run, weights=length[doubt] > offset)
        doubt = doubt[((count > 1) & (unfinished > 0))[run]]
    return rank


def extend(text: np.ndarray, p: np.ndarray, q: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of the suffixes at p and q, of which `known` symbols are known to agree, up to depth."""
    out = np.minimum(known, depth)
    live = np.flatnonzero(out < depth)
    while len(live):
        same = text[p[live] + out[live]] == text[q[live] + out[live]]
        live = live[same]
        out[live] += 1
        live = live[out[live] < depth]
    return out


def doubled(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order to depth symbols and common prefixes, by prefix doubling; text[-1] is a unique least symbol.

    A rank is the place of the first suffix that agrees in the symbols so far. Suffixes whose rank is their own are done.
    """
    n = len(text)
    rank = np.zeros(n, np.int64)
    order = np.argsort(text)
    s = text[order]
    rank[order] = np.maximum.accumulate(np.where(np.append(True, s[1:] != s[:-1]), np.arange(n), 0))
    ranks, width = [], 1
    doubt = order[_shared(rank[order])]
    while True:
        ranks.append(rank.astype(np.int32))
        if width >= depth or not len(doubt):
            break
        # a suffix that is still in doubt doesn't reach the end, which is unique
        old = rank[doubt]
        key = old * (n + 1) + rank[doubt + width]
        by = np.argsort(key)
        doubt, old, key = doubt[by], old[by], key[by]
        place = np.arange(len(doubt))
        group_at = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
        rank_at = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), place, 0))
        order[old + place - group_at] = doubt
        rank[doubt] = old + rank_at - group_at
        doubt = doubt[_shared(rank[doubt])]
        width *= 2
    lcp = np.zeros(n, np.int64)
    live = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]])
    a, b = order[live], order[live + 1]
    for k in range(len(ranks) - 1, -1, -1):
        same = ranks[k][a] == ranks[k][b]
        step = same * (1 << k)
        lcp[live + 1] += step
        a, b = a + step, b + step
    return order, np.minimum(lcp, depth)


def _shared(rank: np.ndarray) -> np.ndarray:
    """Which of these ascending ranks are there twice or more."""
    equal = rank[1:] == rank[:-1]
    return np.append(equal, False) | np.append(False, equal)


def gathered(stream: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same stream in blocks of BLOCK tuples or more."""
    some, n = [], 0
    for one in stream:
        some.append(one)
        n += len(one[0])
        if n >= BLOCK:
            yield DiskQueue.joined(some)
            some, n = [], 0
    if some:
        yield DiskQueue.joined(some)


class InducedSort:
    """One level of the recursion: a text of symbols below `symbols`, whose last one is a unique least."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int, space: Space):
        self.text, self.symbols, self.depth, self.space = text, symbols, depth, space
        self.kind = np.uint32 if len(text) < 1 << 32 else np.int64

    def _coded(self) -> np.ndarray:
        """Twice each symbol, plus 1 where the suffix is smaller than the next one's (the last symbol's is). Equal neighbours share their type."""
        text, n = self.text, len(self.text)
        out = self.space.array(n, np.uint16 if self.symbols < 1 << 15 else np.uint32)
        out[n - 1] = 2 * int(text[n - 1]) + 1
        known = True
        for b in range(n - 1, 0, -CHUNK):
            a = max(0, b - CHUNK)
            here, right = text[a:b], text[a + 1 : b + 1]
            nxt = np.where(here != right, np.arange(b - a), b - a)
            nxt = np.minimum.accumulate(nxt[::-1])[::-1]
            small = np.append(here < right, known)[nxt]
            out[a:b] = (here.astype(out.dtype) << 1) | small
            known = bool(small[0])
        return out

    def _lms(self, coded: np.ndarray) -> np.ndarray:
        def found(a: int) -> np.ndarray:
            here = coded[a : a + CHUNK + 1] & 1
            return np.flatnonzero((here[1:] == 1) & (here[:-1] == 0)) + a + 1

        spots = range(0, len(coded) - 1, CHUNK)
        out, at = self.space.array(sum(len(found(a)) for a in spots), self.kind), 0
        for a in spots:
            own = found(a)
            out[at : at + len(own)] = own
            at += len(own)
        return out

    def _names(self, lms: np.ndarray) -> tuple[np.ndarray, int]:
        """The dense rank of each LMS substring (up to the next LMS position, both ends included), and how many there are.

        Substrings are ranked in parts: those that begin with a range of symbol pairs, about NAMING each.
        """
        m, text, n = len(lms), self.text, len(self.text)
        pairs = self.symbols <= 1 << 11
        spots = range(0, m, CHUNK)

        def lead(a: int) -> np.ndarray:
            at = lms[a : a + CHUNK].astype(np.int64)
            first = text[at].astype(np.int64)
            return first * self.symbols + text[np.minimum(at + 1, n - 1)] if pairs else first

        counts = sum(np.bincount(lead(a), minlength=self.symbols**2 if pairs else self.symbols) for a in spots)
        part = (np.cumsum(counts) - counts) // NAMING
        out, names = self.space.array(m, self.kind), 0
        for p in np.unique(part[counts > 0]).tolist():
            index = np.concatenate([np.flatnonzero(part[lead(a)] == p) + a for a in spots]) if part[-1] else np.arange(m)
            at = lms[index].astype(np.int64)
            after = np.where(index + 1 < m, lms[np.minimum(index + 1, m - 1)].astype(np.int64), at)
            rank = ranks_of(text, at, after - at + 1, int(self.symbols).bit_length())
            dense = np.zeros(len(rank) + 1, np.int64)
            dense[rank] = 1
            dense = np.cumsum(dense) - 1
            out[index] = dense[rank] + names
            names += int(dense[-1]) + 1
        return out, names

    def _order(self, names: np.ndarray, n_names: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (index of an LMS position, how many names it shares with the next larger one), the largest suffix first."""
        m = len(names)
        # LMS positions are two symbols apart at least
        depth = self.depth // 2 + 1
        if n_names == m:
            order = self.space.array(m, self.kind)
            for a in range(0, m, CHUNK):
                order[names[a : a + CHUNK]] = np.arange(a, min(a + CHUNK, m))
            for b in range(m, 0, -BLOCK):
                own = order[max(0, b - BLOCK) : b][::-1]
                yield own, np.zeros(len(own), np.int64)
        elif m <= self.space.base:
            self.space.doublings += 1
            order, shared = doubled(np.asarray(names), depth)
            yield order[::-1], np.append(0, shared[:0:-1])
        else:
            self.space.recursions += 1
            bits = int(n_names).bit_length()
            digits = -(-bits // DIGIT_BITS)
            per = -(-bits // digits)
            reduced = self.space.array((m - 1) * digits + 1, np.uint16)
            for a in range(0, m - 1, CHUNK):
                own = names[a : min(a + CHUNK, m - 1)].astype(np.int64)
                for d in range(digits):
                    reduced[a * digits + d : (a + len(own)) * digits : digits] = ((own >> (per * (digits - 1 - d))) & ((1 << per) - 1)) + 1
            reduced[-1] = 0  # the last name is the least of all, and unique
            low = depth * digits
            for position, prefix in gathered(InducedSort(reduced, (1 << per) + 1, depth * digits, self.space).blocks()):
                # only whole names count: the least prefix since the last of them
                whole = position % digits == 0
                at = np.flatnonzero(whole)
                if not len(at):
                    low = min(low, int(prefix.min()))
                    continue
                least = np.minimum.reduceat(prefix[: at[-1] + 1], np.append(0, at[:-1] + 1)).astype(np.int64)
                least[0] = min(low, int(prefix[: at[0] + 1].min()))
                rest = prefix[at[-1] + 1 :]
                low = min(depth * digits, int(rest.min())) if len(rest) else depth * digits
                yield position[at] // digits, least // digits
            yield np.array([m - 1]), np.zeros(1, np.int64)

    def _seeds(self, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """LMS positions in suffix order, and the common prefix of each with the one before."""
        m = len(lms)
        seeds, prefix, depth = self.space.array(m, self.kind), self.space.array(m + 1, np.uint16), self.depth
        names, n_names = self._names(lms)
        b, last = m, None
        for order, shared in self._order(names, n_names):
            for k in range(0, len(order), BLOCK):
                index, same = order[k : k + BLOCK].astype(np.int64), shared[k : k + BLOCK]
                at = lms[index].astype(np.int64)
                known = np.where(same > depth // 2, depth, lms[np.minimum(index + same, m - 1)].astype(np.int64) - at)
                if last is None:  # the largest has nothing to share with
                    value = np.append(0, extend(self.text, at[1:], at[:-1], known[1:], depth))
                else:
                    value = extend(self.text, at, np.append(last, at[:-1]), known, depth)
                a = b - len(at)
                seeds[a:b] = at[::-1]
                prefix[a + 1 : b + 1] = value[::-1]
                b, last = a, at[-1]
        prefix[0] = 0
        return seeds, prefix[:m]

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes but the last, the largest first, with the common prefix of each with the one before."""
        text, symbols = self.text, self.symbols
        coded = self._coded()
        lms = self._lms(coded)
        seeds, seed_prefix = self._seeds(lms)
        counts = sum((np.bincount(text[lms[a : a + CHUNK]], minlength=symbols) for a in range(0, len(lms), CHUNK)), np.zeros(symbols, np.int64))
        bounds = np.append(0, np.cumsum(counts))
        large, done, little = (DiskQueue(self.kind, symbols, self.space) for _ in range(3))
        try:
            up = Scan(coded, symbols, False, self.depth, large)
            for c in range(symbols):
                last = None
                for position, prefix in large.take(c):
                    done.put(np.full(len(position), c), position, prefix)
                    done.settle()
                    up.feed(position, prefix)
                    last = int(position[-1])
                for a in range(int(bounds[c]), int(bounds[c + 1]), BLOCK):
                    b = min(a + BLOCK, int(bounds[c + 1]))
                    own = np.array(seed_prefix[a:b])
                    if a == bounds[c]:
                        own[0] = 0 if last is None else self.seam(last, int(seeds[a]))
                    up.feed(np.asarray(seeds[a:b]), own)
            down = Scan(coded, symbols, True, self.depth, little)
            for c in range(symbols - 1, -1, -1):
                last = None
                for position, prefix in little.take(c):
                    down.feed(position, prefix)
                    yield position, prefix
                    last = int(position[-1])
                after = None
                for position, prefix in done.take_last(c):
                    if after is None:
                        after = 0 if last is None else self.seam(last, int(position[-1]))
                    turned = np.append(np.uint16(after), prefix[:0:-1]).astype(np.uint16)
                    after = int(prefix[0])
                    down.feed(position[::-1], turned)
                    yield position[::-1], turned
        finally:
            for q in (large, done, little):
                q.close()

    def seam(self, p: int, q: int) -> int:
        """Common prefix of two suffixes, directly: where L and S suffixes of one symbol meet."""
        a, b = self.text[p : p + self.depth], self.text[q : q + self.depth]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array (ascending) and common prefixes, in memory."""
        parts = list(self.blocks())
        order = np.concatenate([p for p, _ in parts] + [np.array([len(self.text) - 1])])[::-1].astype(np.int64)
        down = np.concatenate([x for _, x in parts] + [np.zeros(1, np.uint16)]).astype(np.int64)
        return order, np.append(0, down[:0:-1])


def repeated_starts(text: np.ndarray, symbols: int, lengths: tuple[int, ...], space: Space | None = None, owned: np.ndarray | None = None) -> list[np.ndarray]:
    """For each length and position whether the string of that many symbols from there also starts at another position, both of them owned.

    text[-1] is a unique least symbol. Without `owned` all positions are. `owned` may hold multiplicities: a suffix of
    multiplicity 2 or more stands for several equal ones, each of which has the others beside it in the order.
    """
    space = space or Space()
    out = [space.array(len(text), bool) for _ in lengths]
    last, low = None, max(lengths)
    for position, prefix in gathered(InducedSort(text, symbols, max(lengths), space).blocks()):
        at = np.arange(len(position)) if owned is None else np.flatnonzero(owned[position])
        if not len(at):
            low = min(low, int(prefix.min()))
            continue
        least = np.minimum.reduceat(prefix[: at[-1] + 1], np.append(0, at[:-1] + 1))
        least[0] = min(low, int(prefix[: at[0] + 1].min()))
        rest = prefix[at[-1] + 1 :]
        low = int(rest.min()) if len(rest) else max(lengths)
        own = position[at]
        several = own[owned[own] > 1] if owned is not None else own[:0]
        for found, length in zip(out, lengths, strict=True):
            found[several] = True
            long = least >= length
            found[own[long]] = True
            found[own[:-1][long[1:]]] = True
            if last is not None and long[0]:
                found[last] = True
        last = own[-1]
    return out
