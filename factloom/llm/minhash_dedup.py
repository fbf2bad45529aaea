"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A text is a set of k-word shingles. Its signature has SYMBOLS MinHash values of 15
bits, four to a chunk, which is a long. Two signatures within DISTANCE differing symbols have,
by the pigeonhole principle, at least one chunk with no more errors than that
chunk's allowance, for the allowances sum up to DISTANCE + 1 - CHUNKS. For each
chunk the keys enumerate what its allowance permits (the chunk with each choice of
allowed symbols blanked), so every pair within the distance shares a key.

Pairs are never enumerated within a bucket. First each text meets the smallest id of
each of its buckets, the hub; pairs within the distance are verified on the full
shingle sets and united; each text keeps its full set as seen from the hub, that is
which of the hub's shingles it has, as bits, and the hashes of its others. Then the
texts of a hub that are still in several components are compared with each other on
these full sets, in blocks: those outside the largest component against all others.
A block gives a spanning forest of the links that it finds, not all of them. Pairs
that share a bucket but no hub that both are near (one is beyond the distance from
it) are taken last, from buckets that are still in several components, and verified
on their texts. So every pair within the distance is verified on full sets or
already in one component; texts that are equal word by word count as one throughout.

A pair of Jaccard similarity J differs in a share 1 - J of its symbols on average: at
0.8, 12.8 of 64 (standard deviation 3.2), so DISTANCE = 26 leaves less than one pair
in 10,000 at the very threshold, and fewer above.

Full sets are held as 64-bit sums over 128-bit digests of the words with factors that are drawn anew for each job, so
no choice of words makes different shingles one, and two of a text's or a pair's agree by chance once in 2**64.
Signatures, which only choose candidates, don't depend on the draw.

Defined results: no words (null, empty, white space): set size 0, a component of its
own, kept; a null doc_id: linked with nothing, component null, kept; rows of one
doc_id are one node; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SYMBOLS = 64
LANES = 4
CHUNKS = SYMBOLS // LANES
DISTANCE = 26
#: Texts verified against one hub in a task, about.
HUB_ROWS = 1000
#: Pairs that may be broadcast, three numbers each and their hubs; more are shuffled.
BROADCAST_PAIRS = 50_000
#: Ids of dropped documents that may be broadcast, 8 bytes each; more are shuffled.
BROADCAST_IDS = 200_000
#: Members of a bucket that are compared with others in one task, about.
BLOCK_ROWS = 2000
SYMBOL_BITS = 15
_LANE = (1 << SYMBOL_BITS) - 1


def _parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n odd factors and n summands of 32 bits, from a fixed sequence."""
    x = common.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (x[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (x[n:] >> np.uint64(32)).astype(np.uint32)


def signatures(shingles: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Rows of CHUNKS longs for the texts whose shingle hashes are shingles[to[i]:to[i + 1]] (none empty)."""
    a, b = _parameters(SYMBOLS)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(to) - 1, CHUNKS), np.int64)
    for j in range(SYMBOLS):
        least = np.minimum.reduceat(x * a[j] + b[j], to[:-1])
        symbol = (least * np.uint32(0x9E3779B1)) >> np.uint32(32 - SYMBOL_BITS)
        out[:, j // LANES] |= symbol.astype(np.int64) << (SYMBOL_BITS * (j % LANES))
    return out


def shingle_places(at: np.ndarray, k: int) -> np.ndarray:
    """n + 1 offsets of the texts' shingles."""
    n = np.diff(at)
    return np.concatenate(([0], np.cumsum(np.where(n >= k, n - k + 1, np.minimum(n, 1)))))


def distinct_sizes(shingles: np.ndarray, to: np.ndarray) -> list[int]:
    return [len(np.unique(shingles[a:b])) for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]


SIGNED = "doc_id long, text_key binary, n_shingles long, signature array<long>"


def sign(docs: DataFrame, k: int, secret: bytes) -> DataFrame:
    """A row of SIGNED for each document; key and signature are null without words. Sizes are those of the keyed sets."""
    factors = common.secret_factors(secret, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for lo, hi in common.batches(column, 1 << 19):
                texts = column.slice(lo, hi - lo)
                data, offsets = common.text_buffer(texts)
                data = common.LOWER[data]
                start, end, at = common.word_spans(data, offsets)
                words = common.word_digests(data, start, end)
                shingles, to = common.shingle_hashes(words[:, 0], at, k)
                some = np.flatnonzero(np.diff(to))
                rows = [None] * len(texts)
                if len(some):
                    for i, s in zip(some.tolist(), signatures(shingles, np.append(to[some], to[-1])), strict=True):
                        rows[i] = s
                keys = [None if s is None else hashlib.blake2b(b" ".join(data[a:b].tobytes().split()), digest_size=16).digest() for s, a, b in zip(rows, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(keys, pa.binary()), pa.array(distinct_sizes(common.keyed_shingles(words, at, factors), to), pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                    ["doc_id", "text_key", "n_shingles", "signature"],
                )
        common.release()

    return docs.select("doc_id", "text").mapInArrow(run, SIGNED)


def allowances(distance: int = DISTANCE, chunks: int = CHUNKS) -> list[int]:
    """Errors allowed in each chunk; their sum is distance + 1 - chunks."""
    base, more = divmod(distance + 1, chunks)
    return [base - 1 + (i < more) for i in range(chunks)]


def blanks(errors: int) -> list[int]:
    """Masks over a chunk's lanes, one for each way to blank `errors` of them."""
    return [sum(_LANE << (SYMBOL_BITS * lane) for lane in range(LANES) if lane not in c) for c in combinations(range(LANES), errors)]


def index_keys(distance: int = DISTANCE) -> Column:
    """All keys of a signature."""
    out = []
    for c, allowed in enumerate(allowances(distance)):
        if allowed >= 0:
            out += [F.xxhash64(F.lit(c * 64 + v), F.col("signature")[c].bitwiseAND(F.lit(m).cast("long"))) for v, m in enumerate(blanks(allowed))]
    return F.array(*out)


def hamming(a: str, b: str) -> Column:
    """Differing symbols of two signature columns, by bit arithmetic on whole chunks: a lane's top bit is set where any of its bits is."""
    low = f"{sum((_LANE >> 1) << (SYMBOL_BITS * lane) for lane in range(LANES))}L"
    high = f"{sum(1 << (SYMBOL_BITS * lane + SYMBOL_BITS - 1) for lane in range(LANES))}L"
    one = lambda x: f"bit_count((((({x}) & {low}) + {low}) | ({x})) & {high})"
    return F.expr(" + ".join(one(f"{a}[{i}] ^ {b}[{i}]") for i in range(CHUNKS)))


def near(a: str, b: str, percent: int, distance: int) -> Column:
    """What a linked pair must satisfy: sizes that permit the similarity, and the signature distance."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (hamming(f"{a}.signature", f"{b}.signature") <= distance)


def verify(pairs: DataFrame, docs: DataFrame, k: int, percent: int, secret: bytes, hub_rows: int = HUB_ROWS, keep_sets: bool = False) -> DataFrame:
    """The pairs (x, hub) with `linked`, that is 100 * intersection >= percent * union of the full sets; `bits`: which shingles of the hub x has; `others`: the hashes of those it has besides.

    Texts meet their hub's in sorted runs and pass one at a time; a hub with many pairs is dealt to as many runs as needed.
    """
    factors = common.secret_factors(secret, k)
    load = pairs.groupBy("hub").agg(F.count("*").alias("load"))
    dealt = pairs.join(load, "hub").select("hub", "x", F.pmod(F.xxhash64("x"), F.ceil(F.col("load") / hub_rows)).alias("run"))
    asked = dealt.select(F.col("x").alias("doc_id"), "hub", "run").union(dealt.select(F.col("hub").alias("doc_id"), "hub", "run").distinct())
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    if pairs.count() <= BROADCAST_PAIRS:
        asked = F.broadcast(asked)
    met = asked.join(texts, "doc_id").repartition("hub", "run").sortWithinPartitions("hub", "run", F.col("doc_id") != F.col("hub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple] = []
            for lo, hi in common.batches(batch.column("text"), 1 << 19):
                part = batch.slice(lo, hi - lo)
                data, offsets = common.text_buffer(part.column("text"))
                data = common.LOWER[data]
                start, end, at = common.word_spans(data, offsets)
                shingles, to = common.keyed_shingles(common.word_digests(data, start, end), at, factors), shingle_places(at, k)
                for i, (x, hub, r) in enumerate(zip(*(part.column(c).to_pylist() for c in ("doc_id", "hub", "run")), strict=True)):
                    mine = np.unique(shingles[to[i] : to[i + 1]])
                    if x == hub:
                        if held != (hub, r):
                            held, own = (hub, r), mine
                    elif held == (hub, r) and len(mine):
                        has = np.isin(own, mine, assume_unique=True)
                        both = int(has.sum())
                        linked = 100 * both >= percent * (len(own) + len(mine) - both)
                        rest = mine[~np.isin(mine, own, assume_unique=True)]
                        out.append((x, hub, linked, rest.tobytes() if keep_sets else None, np.packbits(has).tobytes() if keep_sets else None))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["x", "hub", "linked", "others", "bits"])

    return met.select("doc_id", "text", "hub", "run").mapInArrow(run, "x long, hub long, linked boolean, others binary, bits binary")


_LOW = np.uint64(sum((_LANE >> 1) << (SYMBOL_BITS * lane) for lane in range(LANES)))
_HIGH = np.uint64(sum(1 << (SYMBOL_BITS * lane + SYMBOL_BITS - 1) for lane in range(LANES)))


class Members:
    """Members of a group as arrays: node, component, size, signature, and what else is given."""

    def __init__(self, rows: list[tuple]):
        self.node, self.component, self.size = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        self.signature = np.array([r[3] for r in rows], np.int64).view(np.uint64)
        self.rest = [r[4:] for r in rows]

    def near(self, one: "Members", i: int, open_: np.ndarray, percent: int, distance: int) -> np.ndarray:
        """Of the open members those whose size and signature permit a link with member i of the other."""
        n = one.size[i]
        at = np.flatnonzero(open_ & (100 * np.minimum(n, self.size) >= percent * np.maximum(n, self.size)))
        x = self.signature[at] ^ one.signature[i]
        return at[np.bitwise_count((((x & _LOW) + _LOW) | x) & _HIGH).sum(axis=1) <= distance]


class Sets:
    """Full sets of a hub's texts: bits over the hub's shingles and hashes of the others."""

    def __init__(self, rows: list[tuple]):
        width = -(-len(rows[0][1]) // 8) * 8
        self.bits = np.frombuffer(b"".join(b.ljust(width, b"\0") for _, b in rows), np.uint64).reshape(len(rows), -1)
        parts = [np.frombuffer(o, np.uint64) for o, _ in rows]
        self.others, self.to = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def shared(self, one: "Sets", i: int, at: np.ndarray) -> np.ndarray:
        """Size of the intersection of set i of the other with each of these."""
        within = np.bitwise_count(self.bits[at] & one.bits[i]).sum(axis=1).astype(np.int64)
        own = one.others[one.to[i] : one.to[i + 1]]
        if not len(own):
            return within
        size = self.to[at + 1] - self.to[at]
        flat = np.repeat(self.to[at] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        return within + np.bincount(np.repeat(np.arange(len(at)), size), weights=np.isin(self.others[flat], own), minlength=len(at)).astype(np.int64)


def spanning_links(left: list[tuple], right: list[tuple], percent: int, distance: int) -> list[tuple[int, int]]:
    """Links between left and right members of different components, as a forest over the components. Rows: node, component, size, signature, others, bits."""
    a, b = Members(left), Members(right)
    sets_a, sets_b = Sets(a.rest), Sets(b.rest)
    # components are united as links are found, so that no pair is looked at that is joined already
    where = np.unique(np.concatenate((a.component, b.component)))
    mark = np.arange(len(where))
    of_a, of_b = np.searchsorted(where, a.component), np.searchsorted(where, b.component)
    out = []
    for i in range(len(left)):
        at = b.near(a, i, mark[of_b] != mark[of_a[i]], percent, distance)
        if not len(at):
            continue
        shared = sets_b.shared(sets_a, i, at)
        for j in at[100 * shared >= percent * (a.size[i] + b.size[at] - shared)].tolist():
            if mark[of_b[j]] != mark[of_a[i]]:
                out.append((int(a.node[i]), int(b.node[j])))
                mark[mark == mark[of_b[j]]] = mark[of_a[i]]
    return out


def far_pairs(left: list[tuple], right: list[tuple], percent: int, distance: int) -> list[tuple[int, int]]:
    """Pairs (smaller, larger node) of different components that share no hub, each from the first bucket that it shares. Rows: node, component, size, signature, hubs, place of the bucket's key."""
    a, b = Members(left), Members(right)
    chunk, mask = _key_masks(distance)
    hubs = [set(h or ()) for h, _ in b.rest]
    out = set()
    for i, (mine, place) in enumerate(a.rest):
        mine = set(mine or ())
        at = b.near(a, i, b.component != a.component[i], percent, distance)
        earlier = ((b.signature[at][:, chunk[:place]] ^ a.signature[i][chunk[:place]]) & mask[:place] == 0).any(axis=1)
        for j in at[~earlier].tolist():
            if mine.isdisjoint(hubs[j]):
                x, y = int(a.node[i]), int(b.node[j])
                out.add((min(x, y), max(x, y)))
    return sorted(out)


def _key_masks(distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunk and mask of each key of `index_keys`, in its order."""
    every = [(c, m) for c, allowed in enumerate(allowances(distance)) if allowed >= 0 for m in blanks(allowed)]
    return np.array([c for c, _ in every]), np.array([m for _, m in every], np.uint64)


def compared(groups: DataFrame, key: str, attach, extra: list[str], solve, block: int = BLOCK_ROWS) -> DataFrame:
    """Pairs u, v that `solve` gives for the groups (key, node, component, seed) that lie in several components.

    A group's members are dealt to blocks; its seeds go to all of them, in blocks of their own; without a seed column
    they are the members outside the largest component. Most groups are one block. `attach` adds n_shingles, signature
    and extra to the rows that are left.
    """
    given = "seed" in groups.columns
    sizes = groups.groupBy(key, "component").agg(F.count("*").alias("n"), (F.count_if("seed") if given else F.lit(0)).alias("s"))
    several = sizes.groupBy(key).agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("parts")).where("parts > 1")
    seeds = F.col("s") if given else F.col("n") - F.col("most.n")
    several = several.select(key, F.col("most.component").alias("main"), F.ceil(F.col("n") / block).cast("int").alias("all_blocks"), F.ceil(seeds / block).cast("int").alias("seed_blocks")).where("seed_blocks > 0")
    rows = groups.join(several, key).withColumn("draw", F.xxhash64("node"))
    rows = rows if given else rows.withColumn("seed", F.col("component") != F.col("main"))
    cell = lambda i, j, left: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(left).alias("left"))
    i, j = F.pmod("draw", "all_blocks"), F.pmod("draw", "seed_blocks")
    none = F.array().cast("array<struct<i:int,j:int,left:boolean>>")
    to_all = F.transform(F.sequence(F.lit(0), F.col("seed_blocks") - 1), lambda b: cell(i, b, False))
    to_own = F.when(F.col("seed"), F.transform(F.sequence(F.lit(0), F.col("all_blocks") - 1), lambda b: cell(b, j, True)))
    carried = ["node", "component", "n_shingles", "signature", *extra]
    dealt = attach(rows).select(key, *carried, F.explode(F.concat(to_all, F.coalesce(to_own, none))).alias("cell"))
    dealt = dealt.select(key, "cell.i", "cell.j", "cell.left", *carried).repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[n] for p in found], pa.int64()) for n in (0, 1)], ["u", "v"])

        now, left, right = None, [], []
        for batch in batches:
            for k, i, j, is_left, *row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns)), strict=True):
                if (k, i, j) != now:
                    if left and right:
                        yield pairs(solve(left, right))
                    now, left, right = (k, i, j), [], []
                (left if is_left else right).append(tuple(row))
        if left and right:
            yield pairs(solve(left, right))

    return dealt.mapInArrow(run, "u long, v long").distinct()


def link(docs: DataFrame, k: int = 5, percent: int = 80, distance: int = DISTANCE, block: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(signed documents, text_key and component of the texts); a node is the smallest doc_id of a word sequence."""
    secret = os.urandom(16)
    signed = common.cut(sign(docs, k, secret))
    texts = signed.where("text_key is not null and doc_id is not null")
    nodes = common.cut(texts.groupBy("text_key").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))
    keyed = nodes.select("node", F.posexplode(index_keys(distance)).alias("place", "key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").select("key", "hub")
    members = common.cut(keyed.join(shared, "key"))
    signs = nodes.select("node", "n_shingles", "signature")
    x, h = signs.alias("x"), signs.alias("h")
    stars = members.where("node <> hub").select("node", "hub").distinct()
    stars = stars.join(x, stars.node == F.col("x.node")).join(h, stars.hub == F.col("h.node")).where(near("x", "h", percent, distance)).select(stars.node.alias("x"), stars.hub.alias("hub"))
    verified = common.cut(verify(common.cut(stars), docs, k, percent, secret, keep_sets=True))

    def placed(rows: DataFrame, found: DataFrame) -> DataFrame:
        return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))

    edges = verified.where("linked").select(F.col("x").alias("u"), F.col("hub").alias("v"))
    found = components(edges)
    # the texts near a hub against each other (the hub has met them all)
    known = verified.select("hub", F.col("x").alias("node"), "others", "bits").dropDuplicates(["hub", "node"])
    near_hub = common.cut(placed(known.select("hub", "node"), found))
    more = compared(near_hub, "hub", lambda rows: rows.join(known, ["hub", "node"]).join(signs, "node"), ["others", "bits"], lambda a, b: spanning_links(a, b, percent, distance), block)
    edges = edges.union(common.cut(more))
    found = components(edges)
    # pairs of a bucket without a common hub: one of the two is far from the bucket's hub
    hubs = known.select("node", "hub").union(known.select("hub", "hub")).distinct()
    lists = hubs.groupBy("node").agg(F.collect_set("hub").alias("hubs"))
    rest = placed(members, found).join(hubs.withColumn("is_near", F.lit(True)), ["node", "hub"], "left")
    rest = common.cut(rest.select("key", "node", "component", "place", F.col("is_near").isNull().alias("seed")))
    far = compared(rest, "key", lambda rows: rows.join(signs, "node").join(lists, "node", "left"), ["hubs", "place"], lambda a, b: far_pairs(a, b, percent, distance), block)
    far = common.cut(far.select(F.col("u").alias("hub"), F.col("v").alias("x")))
    if not far.isEmpty():
        found = components(edges.union(verify(far, docs, k, percent, secret).where("linked").select(F.col("x").alias("u"), F.col("hub").alias("v"))))
    return signed, placed(nodes.select("text_key", "node"), found).select("text_key", "component")


def dedup(docs: DataFrame, k: int = 5, percent: int = 80, distance: int = DISTANCE, block: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each document."""
    signed, placed = link(docs, k, percent, distance, block)
    rows = signed.select("doc_id", "n_shingles", "text_key").join(placed, "text_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def representatives(docs: DataFrame, k: int = 5, percent: int = 80, distance: int = DISTANCE) -> DataFrame:
    """The documents, with all their columns, of which each group keeps the one of the smallest doc_id (all rows of that doc_id)."""
    gone = common.cut(dedup(docs, k, percent, distance).where("not kept").select("doc_id").distinct())
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
