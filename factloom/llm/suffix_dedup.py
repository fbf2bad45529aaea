"""Exact removal of repeated passages by suffix order.

A byte goes if it is covered by a LENGTH-byte string that also starts anywhere else
in the corpus. Which strings these are is read from the suffix order and its common
prefixes, made by external induced sorting (`induced_sort`) in independent shards. One
order serves several lengths: common prefixes are known up to the largest.

Shards. Each window of the least length is owned by one of its ANCHOR-byte grams: the
one of least hash, the last of equals. The choice depends on the window's bytes alone,
so equal windows are owned by equal grams, wherever they stand. The windows that one
occurrence of a gram owns follow each other; with their bytes, up to the largest length
from the last start on, they are its stretch. A gram that occurs once in the corpus owns
no repeated window. Equal stretches are counted before anything is sorted: all windows of
a stretch that stands twice or more are repeated, and one of its occurrences stands for
all in the sort. Where a gram's stretches differ, each different one goes once to the
shard of the gram's hash, so all copies of a window meet in one shard. A window of two
different stretches is repeated if the suffix order of the shard shows it. The stretches of
a shard are joined by a separator in one string; of its suffixes those that start an owned
window count, the others are context.

Skew. Copies of texts and near copies make equal stretches, which are counted with
map-side sums and sorted once. A gram with more than HOT_BODIES different stretches is split:
each of its windows goes to the shard of its gram of second least hash, too.

Defined results: a null text is empty; a text shorter than LENGTH loses nothing; rows
that are equal throughout are copies of each other (both are removed where they are
long enough); an empty table gives no rows; further columns are ignored. Texts are
told apart by 128 bits of SHA-256, stretches by 128-bit BLAKE2b digests; what grams are
dealt by is a polynomial hash, on which no result depends.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import discard, written
from .induced_sort import Space, repeated_starts

LENGTH = 400
#: The shorter length of which `report` counts the bytes, without removing them: about 50 words of six bytes.
SHARED = 300
ANCHOR = 64
#: For the short strings of passages: a wider gram would leave few to choose from in a string, and so more of them.
PASSAGE_ANCHOR = 32
SHARD_BYTES = 1 << 20
#: Different stretches of one gram beyond which they are dealt to several shards.
HOT_BODIES = 4096
#: Different stretches of a gram that may be dealt with its neighbours, and bytes of a text whose grams are neighbours.
NEAR, PIECE = 128, 2048
MAX_TASKS = 100_000
#: Windows that are dealt to their grams at a time; a place in them has 20 bits.
STRETCH = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_KEY = ["h1", "h2"]
_BODY = ["gram", "b1", "b2"]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i + width]) for each i, by doubling."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of a polynomial hash: the bytes from a to b have (sums[b] - sums[a]) * inverse_powers[a], the same wherever they stand."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * common.powers(len(raw)), out=total[1:])
    return total


def anchors(raw: np.ndarray, length: int, gram: int, total: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, position, and first and last window of each gram of the text that owns windows."""
    n = len(raw) - gram + 1
    width = length - gram + 1
    if n < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    total = prefix_sums(raw) if total is None else total
    hashes = common.mix((total[gram:] - total[:n]) * common.inverse_powers(n))
    spots, firsts, lasts = [], [], []
    for c in range(0, n - width + 1, STRETCH):
        part = hashes[c : c + STRETCH + width - 1]
        # a window's least gram: the hash's high bits, then the later position
        least = sliding_least((part & ~_PLACE) | (_PLACE - np.arange(len(part), dtype=np.uint64)), width)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        spots.append(c + (_PLACE - (least[first] & _PLACE)).astype(np.int64))
        firsts.append(c + first)
        lasts.append(c + np.append(first[1:], len(least)) - 1)
    at = np.concatenate(spots)
    return hashes[at].view(np.int64), at, np.concatenate(firsts), np.concatenate(lasts)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row and bytes of each text of a batch."""
    for lo, hi in common.batches(batch.column("text")):
        data, offsets = common.text_buffer(batch.column("text").slice(lo, hi - lo))
        for k in range(hi - lo):
            yield lo + k, data[offsets[k] : offsets[k + 1]]


OWNERS = "doc_id long, h1 long, h2 long, gram long, b1 long, b2 long, start long, owned long, size long"


def owners(docs: DataFrame, lengths: tuple[int, ...], gram: int) -> DataFrame:
    """A row of OWNERS for each occurrence of a gram that owns windows: its first window, how many follow each other, and size and digest of its stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = np.zeros(0, np.int64)
            found = [[none] * 7]
            for k, raw in _texts(batch):
                h, _, a, b = anchors(raw, lengths[0], gram)
                end = np.minimum(b + lengths[-1], len(raw))
                view = memoryview(np.ascontiguousarray(raw))
                digests = b"".join([hashlib.blake2b(view[i:j], digest_size=16).digest() for i, j in zip(a.tolist(), end.tolist(), strict=True)])
                body = np.frombuffer(digests, np.int64).reshape(-1, 2)
                found.append([np.full(len(h), k), h, body[:, 0], body[:, 1], a, b - a + 1, end - a])
            at, *rest = (pa.array(np.concatenate(x), pa.int64()) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in ("doc_id", *_KEY)), *rest], ["doc_id", *_KEY, *_BODY, "start", "owned", "size"])
        common.release()

    return docs.mapInArrow(run, OWNERS)


def split_stretch(raw: np.ndarray, owned: int, gram_hash: int, lengths: tuple[int, ...], gram: int) -> Iterator[tuple[int, int, int, int]]:
    """(key, first window, windows, size) of the parts of a stretch whose windows have one gram of second least hash."""
    total = prefix_sums(raw)
    n = len(raw) - gram + 1
    hashes = common.mix((total[gram:] - total[:n]) * common.inverse_powers(n))
    none = np.uint64((1 << 64) - 1)
    hashes[hashes <= np.uint64(gram_hash % (1 << 64))] = none
    second = sliding_least(hashes, lengths[0] - gram + 1)[:owned]
    first = np.flatnonzero(np.append(True, second[1:] != second[:-1]))
    for a, b, key in zip(first.tolist(), [*first[1:].tolist(), owned], common.mix(second[first] ^ np.uint64(gram_hash % (1 << 64))).tolist(), strict=True):
        yield key, a, b - a, min(b - a - 1 + lengths[-1], len(raw) - a)


STRETCHES = "shard long, k1 long, k2 long, k3 long, at long, offset long, gram long, b1 long, b2 long, owned long, size long, several boolean, body binary"
_STRING = ["k1", "k2", "k3", "at"]


def stretches(texts: DataFrame, shards: int, lengths: tuple[int, ...], gram: int) -> DataFrame:
    """A row of STRETCHES for each stretch that is to be sorted.

    k1, k2, k3: the first stretch of its string; at: of a split stretch where the part begins; offset: where the stretch
    begins in its string, whose bytes are with the first.
    """
    names = [f.split()[0] for f in STRETCHES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, out, held = batch.column("parts"), [], 0
            ends, flat = lists.offsets.to_numpy(), lists.values
            columns = ("start", "owned", "size", *_BODY, "several", "key", "hot")
            part = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in (*columns, "sort")}
            for k, raw in _texts(batch):
                mine = np.arange(ends[k], ends[k + 1])
                mine = mine[part["sort"][mine]]
                mine = mine[np.argsort(part["start"][mine], kind="stable")]
                string: list[tuple] = []  # stretches that follow each other: (start, owned, size, body, several, key)
                for start, windows, size, *body, several, key, hot in zip(*(part[c][mine].tolist() for c in columns), strict=True):
                    if string and (hot or string[-1][0] + string[-1][1] != start or string[-1][5] != key):
                        held += add(out, raw, string)
                        string = []
                    if not hot:
                        string.append((start, windows, size, body, several, key))
                        continue
                    whole = raw[start : start + size]
                    for own, at, owned, n in split_stretch(whole, windows, body[0], lengths, gram):
                        out.append((own % shards, *body, at, 0, *body, owned, n, several, whole[at : at + n].tobytes()))
                        held += n
                held += add(out, raw, string) if string else 0
                if held > 4 << 20 or len(out) > 1 << 14:
                    yield pack(out)
                    out, held = [], 0
            yield pack(out)
        common.release()

    def add(out: list[tuple], raw: np.ndarray, string: list[tuple]) -> int:
        first, id_, key = string[0][0], string[0][3], string[0][5]
        end = max(start + size for start, _, size, *_ in string)
        for start, owned, size, body, several, _ in string:
            out.append((key % shards, *id_, 0, start - first, *body, owned, size, several, raw[first:end].tobytes() if start == first else b""))
        return end - first

    def pack(out: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 11, pa.bool_(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return texts.mapInArrow(run, STRETCHES)


def sorted_bytes(texts: DataFrame) -> DataFrame:
    """n: the bytes that `stretches` sends to be sorted, for each batch of texts (but for stretches that are split)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("parts")
            flat = lists.flatten()
            part = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "owned", "size", "sort", "key", "hot")}
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            mine = np.flatnonzero(part["sort"])
            mine = mine[np.lexsort((part["start"][mine], row[mine]))]
            start, owned, size, key, hot, row = (*(part[c][mine] for c in ("start", "owned", "size", "key", "hot")), row[mine])
            goes_on = np.zeros(len(mine), bool)
            goes_on[:-1] = ~hot[:-1] & ~hot[1:] & (key[:-1] == key[1:]) & (row[:-1] == row[1:]) & (start[:-1] + owned[:-1] == start[1:])
            yield pa.RecordBatch.from_arrays([pa.array([int(np.where(goes_on, owned, size).sum())], pa.int64())], ["n"])

    return texts.select("parts").mapInArrow(run, "n long")


_SEPARATOR = np.uint16(1).tobytes()
FOUND = "gram long, b1 long, b2 long, length int, start long, end long"


def repeats(parts: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """A row of FOUND for each covered run of a stretch that a shard's suffix order shows. A shard is read in a stream into two files, its string and the multiplicity (2 for more) of each position that is owned."""

    def solve(text_file, owned_file, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        text_file.write(np.zeros(1, np.uint16).tobytes())
        owned_file.write(b"\0")
        text_file.flush(), owned_file.flush()
        text, owned = (np.asarray(np.memmap(f, kind, "r")) for f, kind in ((text_file, np.uint16), (owned_file, np.uint8)))
        flags = repeated_starts(text, 258, lengths, Space(os.path.dirname(text_file.name)), owned)
        *body, start, windows, size, begin = (np.array([r[i] for r in rows], np.int64) for i in range(7))
        for flag, length in zip(flags, lengths, strict=True):
            at = np.flatnonzero(flag)
            row = np.searchsorted(begin, at, "right") - 1
            at = at - begin[row]
            # a shorter rest of a text is no string of this length
            use = at < np.minimum(windows, size - length + 1)[row]
            at, row = at[use], row[use]
            if len(at):
                first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (at[1:] - at[:-1] > length)))
                last, of = np.append(first[1:], len(at)) - 1, row[first]
                fields = [*(b[of] for b in body), np.full(len(first), length, np.int32), start[of] + at[first], start[of] + at[last] + length]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in fields], [*_BODY, "length", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            now, files, rows, string, held, flags = None, None, [], None, 0, 0

            def ended() -> None:
                """The string is over: what of it is not owned, and the separator."""
                if string is not None:
                    files[1].write(bytes(held - flags))

            def closed() -> Iterator[pa.RecordBatch]:
                if files:
                    ended()
                    yield from solve(*files, rows)
                for f in files or ():
                    f.close()
                    os.unlink(f.name)

            for batch in batches:
                for shard, *key, offset, gram, b1, b2, owned, size, several, body in zip(*(batch.column(f.split()[0]).to_pylist() for f in STRETCHES.split(", ")), strict=True):
                    if shard != now:
                        yield from closed()
                        now, rows, string, held, flags = shard, [], None, 0, 0
                        files = [open(os.path.join(folder, f"{shard}{x}"), "w+b") for x in "to"]  # noqa: SIM115
                    if key != string:
                        ended()
                        flags, string = held, key
                        files[0].write((np.frombuffer(body, np.uint8).astype(np.uint16) + np.uint16(2)).tobytes() + _SEPARATOR)
                        begin, held = held, held + len(body) + 1
                    elif offset + begin != flags:
                        continue  # a repeated row of one text
                    files[1].write((b"\2" if several else b"\1") * owned)
                    flags += owned
                    rows.append((gram, b1, b2, key[3], owned, size, begin + offset))
            yield from closed()
        common.release()

    return parts.mapInArrow(run, FOUND)


def runs(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of intervals, as maximal runs."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def text_keys(text: Column) -> list[Column]:
    """Two numbers that tell texts apart: 128 bits of SHA-256."""
    return [F.conv(F.substring(F.sha2(text, 256), at, 16), 16, -10).cast("long") for at in (1, 17)]


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), *(k.alias(n) for k, n in zip(text_keys(text), _KEY, strict=True)))


def spans(docs: DataFrame, lengths: tuple[int, ...], gram: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot: int = HOT_BODIES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their keys; the texts that hold repeats, with their stretches; the runs to remove: h1, h2, copies, runs_<length>). lengths ascend."""
    rows = keyed(docs)
    long = rows.where(F.octet_length("text") >= lengths[0])
    own = written(owners(long, lengths, gram), "owners")
    # written, so that the join deals both sides anew and a gram of many occurrences can be split
    often = written(own.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "often")
    repeated = written(own.join(often.hint("shuffle_hash"), "gram"), "repeated")
    discard(own, often)
    place = F.struct(*_KEY, "start")
    bodies = written(repeated.groupBy(*_BODY).agg(F.count("*").alias("n"), F.min(place).alias("one")), "bodies")
    grams = written(bodies.groupBy("gram").agg(F.count("*").alias("bodies"), F.min("one").alias("home")), "grams")
    key = F.when(F.col("bodies") <= NEAR, F.xxhash64("home.h1", "home.h2", F.expr(f"home.start div {PIECE}"))).otherwise(F.col("gram"))
    known = bodies.join(grams, "gram").select(*_BODY, "one", (F.col("n") > 1).alias("several"), key.alias("key"), (F.col("bodies") > hot).alias("hot"))
    part = F.struct("start", "owned", "size", *_BODY, "several", (place == F.col("one")).alias("sort"), "key", "hot")
    placed = repeated.join(known.hint("shuffle_hash"), _BODY).select("doc_id", *_KEY, part.alias("part"))
    # one row stands for all with its text
    wanted = placed.groupBy(*_KEY).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.collect_set("part").alias("parts"))
    a, b = long.alias("a"), wanted.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
    texts = written(a.join(b, same).select("a.h1", "a.h2", "text", F.expr("n div size(parts)").alias("copies"), "parts"), "repeats")
    discard(repeated, bodies, grams)
    total = sorted_bytes(texts).agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(shards, MAX_TASKS))
    dealt = stretches(texts, shards, lengths, gram).repartition(tasks, "shard").sortWithinPartitions("shard", *_STRING, "offset")
    found = written(repeats(dealt, lengths).groupBy(*_BODY).agg(*(F.collect_set(F.when(F.col("length") == n, F.struct("start", "end"))).alias(f"found_{n}") for n in lengths)), "found")
    # every occurrence of a stretch takes what the order shows for it
    each = texts.select(*_KEY, "copies", "parts").dropDuplicates(_KEY).select(*_KEY, "copies", F.explode("parts").alias("p")).select(*_KEY, "copies", "p.start", *(f"p.{c}" for c in _BODY))
    moved = lambda n: F.transform(f"found_{n}", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), (r["end"] + F.col("start")).alias("end")))
    met = each.join(found.hint("shuffle_hash"), _BODY).select(*_KEY, "copies", *(moved(n).alias(f"found_{n}") for n in lengths))
    marked = met.groupBy(*_KEY).agg(F.first("copies").alias("copies"), *(F.flatten(F.collect_list(f"found_{n}")).alias(f"runs_{n}") for n in lengths))
    marked = written(marked.where(" or ".join(f"size(runs_{n}) > 0" for n in lengths)), "runs")
    discard(found)
    return rows, texts, marked


def run_lists(column: pa.ListArray) -> Iterator[list[tuple[int, int]]]:
    """The union of each row's intervals (structs of start and end), as maximal runs."""
    ends, flat = column.offsets.to_numpy(), column.values
    starts, stops = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "end"))
    for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        order = np.argsort(starts[i:j], kind="stable")
        a, b = starts[i:j][order], np.maximum.accumulate(stops[i:j][order]) if j > i else stops[i:j]
        new = np.flatnonzero(np.append(True, a[1:] > b[:-1])) if j > i else np.zeros(0, np.int64)
        yield list(zip(a[new].tolist(), b[np.append(new[1:], j - i) - 1].tolist() if j > i else [], strict=True))


def stripped(raw: np.ndarray, where: list[tuple[int, int]]) -> np.ndarray:
    keep = np.ones(len(raw), bool)
    for a, b in where:
        keep[a:b] = False
    return raw[keep]


def removal(texts: DataFrame, marked: DataFrame, length: int, shared: int | None = None) -> DataFrame:
    """h1, h2, n_removed, n_spans, kept_sha256, n_shared for each text with repeats. n_shared: bytes that strings of the length `shared` cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            lists = [run_lists(batch.column(f"runs_{n}")) for n in (length, shared or length)]
            for (_, raw), where, more in zip(_texts(batch), *lists, strict=True):
                size = lambda w: sum(b - a for a, b in w)
                rows.append((size(where), len(where), hashlib.sha256(stripped(raw, where).tobytes()).hexdigest(), size(more)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], [*_KEY, "n_removed", "n_spans", "kept_sha256", "n_shared"])

    one = texts.select(*_KEY, "text").join(marked, _KEY)
    return one.mapInArrow(run, "h1 long, h2 long, n_removed long, n_spans long, kept_sha256 string, n_shared long").dropDuplicates(_KEY)


def report(docs: DataFrame, length: int = LENGTH, shared: int = SHARED) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared for each document; n_shared: its bytes that strings of `shared` bytes cover which also start elsewhere."""
    rows, texts, marked = spans(docs, tuple(sorted({length, shared})))
    lost = written(removal(texts, marked, length, shared), "lost")
    discard(texts, marked)
    slim = rows.select("doc_id", *_KEY, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return slim.join(lost, _KEY, "left").select("doc_id", "n_bytes", none("n_removed"), none("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"), none("n_shared"))


def at_code_points(raw: np.ndarray, where: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the parts of code points at their ends."""
    inner = (raw & 0xC0) == 0x80
    out = []
    for a, b in where:
        while a < b and inner[a]:
            a += 1
        while b > a and b < len(raw) and inner[b]:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents, with all their columns, without the bytes that `spans` marks; n_chars, where it is there, is counted anew.

    Runs are drawn in to whole code points. A document that loses text and has none but white space left goes.
    """
    _, texts, marked = spans(docs, (length,))
    discard(texts)
    marked = marked.select(*_KEY, F.col(f"runs_{length}").alias("spans"), F.lit(None).cast("array<long>").alias("lonely"))
    return _without(docs, marked, lambda raw, text, where, lonely: at_code_points(raw, where))


def pieces(text: str) -> list[tuple[int, int]]:
    """Start and end of each word, in bytes: what stands between white space."""
    found = [m.span() for m in re.finditer(r"\S+", text)]
    if text.isascii():
        return found
    at = np.append(0, np.cumsum([len(c.encode()) for c in text])).tolist()
    return [(at[a], at[b]) for a, b in found]


def passages(raw: np.ndarray, text: str, where: list[tuple[int, int]], words: int) -> Iterator[tuple[int, int, int, int]]:
    """Start and end of each least string of a number of words that lies within a run, and of these words as far as the run has them.

    The least string goes from the last code point of a word to the first of the word `words - 1` on, so each string
    with that many pieces between white space holds one, no matter where in a word it starts and ends.
    """
    found = pieces(text)
    starts, ends = (np.array([p[i] for p in found], np.int64) for i in (0, 1))
    head = np.flatnonzero((raw & 0xC0) != 0x80)
    before, after = head[np.searchsorted(head, ends) - 1], np.append(head, len(raw))[np.searchsorted(head, starts, "right")]
    for a, b in where:
        first, last = int(np.searchsorted(before, a)), int(np.searchsorted(after, b, "right")) - words
        for k in range(first, last + 1):
            yield int(before[k]), int(after[k + words - 1]), max(a, int(starts[k])), min(b, int(ends[k + words - 1]))


def lonely_passages(texts: DataFrame, marked: DataFrame, words: int) -> DataFrame:
    """h1, h2, lonely: the starts of those least strings of `passages` that are in one place of the corpus only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = [batch.column(c).to_pylist() for c in (*_KEY, "copies")], run_lists(batch.column("spans"))
            rows: list[tuple] = []
            for k, raw in _texts(batch):
                where, body = next(lists), raw.tobytes()
                for a, b, _, _ in passages(raw, body.decode(), where, words):
                    digest = hashlib.blake2b(body[a:b], digest_size=16).digest()
                    rows.append((int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True), keys[0][k], keys[1][k], a, keys[2][k]))
                if len(rows) > 1 << 16:
                    yield pack(rows)
                    rows = []
            yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(6)], ["p1", "p2", *_KEY, "start", "copies"])

    one = texts.select(*_KEY, "text").join(marked, _KEY).dropDuplicates(_KEY)
    all_ = one.mapInArrow(run, "p1 long, p2 long, h1 long, h2 long, start long, copies long")
    # a passage in one place has one row, which the least of each column is; common ones shrink before the shuffle
    alone = all_.groupBy("p1", "p2").agg(F.sum("copies").alias("n"), *(F.min(c).alias(c) for c in (*_KEY, "start"))).where("n = 1")
    return alone.groupBy(*_KEY).agg(F.collect_list("start").alias("lonely"))


def without_passages(docs: DataFrame, words: int, gram: int = PASSAGE_ANCHOR) -> DataFrame:
    """The documents as `without_repeats` gives them, without the passages of `words` words or more that stand anywhere else, too.

    A byte goes if it is covered by a string with that many pieces between white space that also starts elsewhere.
    Such a string has 2 * words - 1 bytes or more, so the runs of that length hold all of them; within the runs,
    strings of so many words are counted. Of the words at a passage's ends goes what the run holds.
    """
    length = 2 * words - 1
    _, texts, marked = spans(docs, (length,), min(gram, words))
    marked = marked.withColumnRenamed(f"runs_{length}", "spans")
    lonely = written(lonely_passages(texts, marked, words), "lonely")
    discard(texts)
    both = marked.join(lonely, _KEY, "left")

    def chosen(raw: np.ndarray, text: str, where: list[tuple[int, int]], lonely: list[int] | None) -> list[tuple[int, int]]:
        alone = set(lonely or ())
        return at_code_points(raw, runs([(c, d) for a, _, c, d in passages(raw, text, where, words) if a not in alone]))

    return _without(docs, both, chosen)


def _without(docs: DataFrame, marked: DataFrame, chosen: Callable) -> DataFrame:
    """The documents without the runs that chosen(bytes, text, runs, lonely) takes of those marked (h1, h2, spans, lonely)."""
    text, names, own = F.coalesce("text", F.lit("")), docs.columns, "_ft"
    while any(n.lower().startswith(own) for n in names):  # names that the documents don't have
        own += "_"
    key = [own + c for c in _KEY]
    rows = docs.withColumns(dict(zip(key, text_keys(text), strict=True)))
    marks = marked.select(*(F.col(c).alias(own + c) for c in (*_KEY, "spans", "lonely")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column("text").to_pylist(), []
            for k, (where, lonely) in enumerate(zip(*(batch.column(own + c).to_pylist() for c in ("spans", "lonely")), strict=True)):
                keep.append(True)
                if where:
                    whole = texts[k] or ""
                    raw = np.frombuffer(whole.encode(), np.uint8)
                    gone = chosen(raw, whole, runs([(s["start"], s["end"]) for s in where]), lonely)
                    texts[k] = stripped(raw, gone).tobytes().decode()
                    keep[-1] = not gone or bool(texts[k].strip())
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64())}
            columns = [new[n].cast(batch.column(n).type) if n in new else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep, pa.bool_()))
        common.release()

    return rows.join(marks, key, "left").select(*names, own + "spans", own + "lonely").mapInArrow(run, docs.schema)
