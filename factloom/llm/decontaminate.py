"""Benchmark decontamination by SimHash windows.

Texts are read as lower-cased words; a window has as many words as the benchmark
item that it is held against. Its fingerprint is a SimHash of its weighted five-word
shingles (the weight is the count): BLOCKS blocks of BLOCK_BITS bits. A pair within
RADIUS bits has, by the pigeonhole principle, at least one block with no more errors
than the block's allowance. The items' blocks are indexed with up to ITEM_ERRORS of
them, a window's block is looked up with the others, so every pair within the radius
is found; of unrelated fingerprints one in 30 is a candidate. Candidates are then verified
by the exact weighted Jaccard similarity of the shingles, which are told apart by keyed
sums of their words' digests (`common.keyed_shingles`). What finds candidates is a
polynomial hash, equal for equal words, so words that it confuses cost time alone.

At similarity 0.8 bits differ with a probability of 0.15, 18.2 of 120 on average with a
standard deviation of 3.9, so RADIUS = 29 misses about two windows in 1000 at the very
threshold, and fewer above.

A window that shares fewer than SIMILARITY of its shingles with the vocabulary of
the items of its size cannot reach SIMILARITY with any of them, so only the others
get a fingerprint; that loses nothing. The items' index is built in blocks of at most
INDEX_BYTES of item text, each broadcast and run over all documents, so a larger
benchmark takes more passes, not more memory.

Defined results: a null or empty text has no hits, nor has a null or empty item; a
text of 1 to 4 words is one shingle; a document shorter than an item is one window;
repeated rows and repeated items give a hit each; of several windows the most
similar counts, of equals the first; an empty table on either side gives no rows.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 6
BLOCK_BITS = 20
BITS = BLOCKS * BLOCK_BITS
RADIUS = 29
ITEM_ERRORS = 1
INDEX_BYTES = 8 << 20
HITS = "doc_id long, item_id long, start_word long, n_words long, similarity double, hamming int"


def projections(shingles: np.ndarray) -> np.ndarray:
    """For each shingle hash BITS signed numbers: its coordinates on so many random axes."""
    parts = [common.mix(shingles + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) & (2**64 - 1))) for j in range(BITS // 8)]
    return np.stack(parts, axis=1).view(np.int8).astype(np.int32)


def pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, a row of BLOCKS numbers each: a bit for each axis on which the sum is positive."""
    return ((sums > 0).reshape(len(sums), BLOCKS, BLOCK_BITS) @ (1 << np.arange(BLOCK_BITS))).astype(np.uint32)


def flips(errors: int) -> np.ndarray:
    """All ways to change up to so many bits of a block."""
    return np.array([sum(1 << i for i in c) for e in range(errors + 1) for c in combinations(range(BLOCK_BITS), e)], np.uint32)


def allowances(radius: int, blocks: int) -> list[int]:
    """Errors allowed in each block, with sum(a + 1) = radius + 1: fewer in all blocks would need more than radius errors in total."""
    base, more = divmod(radius + 1, blocks)
    return [base - 1 + (i < more) for i in range(blocks)]


class Keys:
    """A block of several fingerprints with up to some errors each: sorted keys, and a bitmap that most other keys miss."""

    def __init__(self, values: np.ndarray, errors: int):
        change = flips(errors)
        keys = (values[:, None] ^ change).ravel()
        order = np.argsort(keys, kind="stable")
        self.keys, self.member = keys[order], np.repeat(np.arange(len(values)), len(change))[order]
        self.mask = np.uint32(min(1 << BLOCK_BITS, 1 << max(12, (64 * len(keys)).bit_length())) - 1)
        self.there = np.zeros(int(self.mask) + 1, bool)
        self.there[keys & self.mask] = True

    def find(self, values: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, member) of values that a change makes a key."""
        rows, members = [], []
        for a in range(0, len(values), 512):
            asked = values[a : a + 512, None] ^ change
            row, which = np.nonzero(self.there[asked & self.mask])
            key = asked[row, which]
            low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
            n = high - low
            rows.append(np.repeat(row + a, n))
            members.append(self.member[np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())] if n.sum() else np.zeros(0, np.int64))
        return np.concatenate(rows), np.concatenate(members)


class Index:
    """Items by their number of shingles, with a multi-index for each such class."""

    def __init__(self, items: list[tuple[int, str | None]], radius: int = RADIUS, similarity: float = SIMILARITY, secret: bytes = b""):
        """secret: what the shingles' keys are made of, which the texts' must be, too."""
        self.radius, self.similarity, self.factors = radius, similarity, common.secret_factors(secret, SHINGLE)
        data, offsets = common.text_buffer(pa.array([t for _, t in items], pa.large_string()))
        self.classes: dict[int, dict] = {}
        vocabulary, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        by_size = defaultdict(list)
        if len(data):
            data = common.LOWER[data]
            start, end, at = common.word_spans(data, offsets)
            plain, to = common.shingle_hashes(common.word_hashes(data, start, end), at, SHINGLE)
            shingles = common.keyed_shingles(common.word_digests(data, start, end), at, self.factors)
            for k, (item, _) in enumerate(items):
                own = shingles[to[k] : to[k + 1]]
                if len(own):
                    by_size[len(own), int(at[k + 1] - at[k])].append((item, own, plain[to[k] : to[k + 1]]))
        self.shapes = list(by_size)
        for c, members in enumerate(by_size.values()):
            vocabulary.append(np.unique(np.concatenate([plain for *_, plain in members])))
            sizes.append(np.full(len(vocabulary[-1]), c))
        self.vocabulary, of = np.unique(np.concatenate(vocabulary), return_inverse=True)
        # the classes of each shingle of the vocabulary
        order = np.argsort(of, kind="stable")
        self.classes_of = np.concatenate(sizes)[order]
        self.first = np.append(0, np.cumsum(np.bincount(of, minlength=len(self.vocabulary)))).astype(np.int64)
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[self.vocabulary >> np.uint64(42)] = True
        allowed = allowances(radius, BLOCKS)
        own = [min(ITEM_ERRORS, a) for a in allowed]
        self.asked = [flips(a - e) if a >= 0 else np.zeros(0, np.uint32) for a, e in zip(allowed, own, strict=True)]
        for (size, words), members in by_size.items():
            prints = np.concatenate([pack(projections(plain).sum(axis=0)[None]) for *_, plain in members])
            self.classes[size, words] = {"members": members, "prints": prints, "blocks": [Keys(prints[:, b], max(0, e)) for b, e in enumerate(own)]}

    def places(self, shingles: np.ndarray) -> np.ndarray:
        """The place of each shingle in the vocabulary, -1 where it isn't there."""
        out = np.full(len(shingles), -1)
        at = np.flatnonzero(self.sieve[shingles >> np.uint64(42)])
        if len(at):
            spot = np.minimum(np.searchsorted(self.vocabulary, shingles[at]), len(self.vocabulary) - 1)
            out[at] = np.where(self.vocabulary[spot] == shingles[at], spot, -1)
        return out

    def shared(self, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each class that a text shares enough shingles with, and their positions in the text."""
        at = np.flatnonzero(places >= 0)
        low, n = self.first[places[at]], self.first[places[at] + 1] - self.first[places[at]]
        position = np.repeat(at, n)
        of = self.classes_of[np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]
        order = np.argsort(of, kind="stable")
        of, position = of[order], position[order]
        cut = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(of)], strict=True):
            if b - a >= self.similarity * self.shapes[of[a]][0] - 1e-9:
                yield int(of[a]), position[a:b]

    def candidates(self, group: dict, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (window, member) within the radius, in order, and their distance."""
        n = len(group["members"])
        found = [block.find(prints[:, b], change) for b, (block, change) in enumerate(zip(group["blocks"], self.asked, strict=True)) if len(change)]
        pair = np.unique(np.concatenate([w * n + m for w, m in found]))
        window, member = pair // n, pair % n
        distance = np.bitwise_count(prints[window] ^ group["prints"][member]).sum(axis=1)
        near = distance <= self.radius
        return window[near], member[near], distance[near]

    def hits(self, plain: np.ndarray, exact: Callable[[], np.ndarray], places: np.ndarray, n_words: int) -> list[tuple]:
        """plain: the shingles' hashes that candidates are found by; exact: gives the keyed ones. (item, start, words, similarity, distance) of a document's best window for each item that it holds."""
        n, sums, shingles, out = len(plain), None, None, []
        for c, position in self.shared(places):
            size, words = self.shapes[c]
            group, width = self.classes[size, words], min(size, n)
            total = np.zeros(n + 1, np.int64)
            total[position + 1] = 1
            total = np.cumsum(total)
            starts = np.flatnonzero(total[width:] - total[: n - width + 1] >= self.similarity * size - 1e-9)
            if not len(starts):
                continue
            if sums is None:
                sums = np.concatenate((np.zeros((1, BITS), np.int32), np.cumsum(projections(plain), axis=0, dtype=np.int32)))
            prints = [pack(sums[some + width] - sums[some]) for some in np.array_split(starts, -(-len(starts) // 4096))]
            window, member, distance = self.candidates(group, np.concatenate(prints))
            shingles = exact() if shingles is None and len(window) else shingles
            best: dict[int, tuple] = {}
            for w, m, d in zip(starts[window].tolist(), member.tolist(), distance.tolist(), strict=True):
                s = weighted_jaccard(shingles[w : w + width], group["members"][m][1])
                if s >= self.similarity and (m not in best or s > best[m][2]):
                    best[m] = (w, min(words, n_words), s, d)
            out += [(group["members"][m][0], *b) for m, b in best.items()]
        return out


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the smaller counts over the sum of the larger ones."""
    both, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = np.bincount(where[: len(a)], minlength=len(both)), np.bincount(where[len(a) :], minlength=len(both))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def document_hits(column, index: Index) -> list[tuple[int, tuple]]:
    """(row, hit) for an Arrow column of texts."""
    out = []
    for a, b in common.batches(column, 1 << 19):
        data, offsets = common.text_buffer(column.slice(a, b - a))
        if not len(data):
            continue
        data = common.LOWER[data]
        start, end, at = common.word_spans(data, offsets)
        plain, to = common.shingle_hashes(common.word_hashes(data, start, end), at, SHINGLE)
        places = index.places(plain)
        for k in np.unique(np.searchsorted(to, np.flatnonzero(places >= 0), side="right") - 1).tolist():
            own = slice(at[k], at[k + 1])
            exact = lambda own=own: common.keyed_shingles(common.word_digests(data, start[own], end[own]), np.array([0, own.stop - own.start]), index.factors)  # noqa: B023, E731
            out += [(a + k, h) for h in index.hits(plain[to[k] : to[k + 1]], exact, places[to[k] : to[k + 1]], int(own.stop - own.start))]
    return out


def item_blocks(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in lists of about index_bytes of text at most."""
    items = benchmark.where("text is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-2 * size // index_bytes) if size > index_bytes else 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """A row of HITS for each document and item that the document holds."""
    out, secret = None, os.urandom(16)
    for items in item_blocks(benchmark, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, radius, similarity, secret)
            for b in batches:
                hits = document_hits(b.column("text"), index)
                ids = b.column("doc_id").take(pa.array([r for r, _ in hits], pa.int64()))
                fields = [pa.array([h[i] for _, h in hits], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([ids, *fields], ["doc_id", "item_id", "start_word", "n_words", "similarity", "hamming"])

        part = docs.select("doc_id", "text").mapInArrow(run, HITS)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The documents, with all their columns, that hold no item. Filters in place: nothing is shuffled."""
    secret = os.urandom(16)
    for items in item_blocks(benchmark, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, radius, similarity, secret)
            for b in batches:
                bad = {r for r, _ in document_hits(b.column("text"), index)}
                yield b.filter(pa.array([k not in bad for k in range(b.num_rows)], pa.bool_())) if bad else b

        docs = docs.mapInArrow(run, docs.schema)
    return docs
