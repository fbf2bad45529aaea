"""Spelling variants: words at one edit from each other, by two-dimensional range reporting over wavelet trees.

Two words are near if one inserted, deleted or replaced code point makes one the other. With the edit at position p, the
first p code points agree and so does what follows the edit. So the words near w at p are the points of a rectangle: an
interval of the words in forward order (those that begin like w) by an interval of the words in reverse order (those that
end like it). A wavelet tree over the reverse ranks in forward order reports the points of each rectangle; lengths are
kept apart (words of one length for replacements, words one longer for insertions, which give the deletions, too).

Spark deals words out by what near words must share: for edits within [a, b) the code points before a and those behind b.
At first the two halves of a word are such spans; the words of one span and key are a group. A group of over MOST words
is dealt anew by the halves of its span, until a span is one position, where a group can't have more words than there
are letters. So no task meets more than BUCKET + MOST words, whatever the words are, and nothing is left out.

A pair is reported at one position only (for insertions the last that fits). Each task adds up what it reports by word:
the number of near words, the most frequent one. Roots are found by pointer jumping: frequencies grow at least tenfold at
each step, so a path has under 19 words and five rounds end it.

Defined results: a null text has no words; a null doc_id counts as an empty string in the key of the damage; repeated
rows are counted as often as they stand; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, release, written

LETTERS = r"A-Za-zÀ-ÿ"
#: Code points and occurrences that a word has at least; each how many occurrences lose a letter; how much more frequent a form is.
LEAST, OCCURS, DAMAGE, MORE = 7, 2, 31, 10
#: Words that a group, and rows that a bucket of groups, may have; points that are held at a time.
MOST, BUCKET, POINTS = 50_000, 100_000, 1 << 21
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
REPLACE, INSERT = 0, 1
GROUP = ["kind", "m", "a", "b", "key"]
FOUND = "word string, n long, n_near long, form string, form_n long"


def counted(docs: DataFrame) -> DataFrame:
    """word, n: the damaged runs of at least LEAST letters that occur at least OCCURS times. Built-in functions, one partial aggregation."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{LEAST},}}+"), 0)).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    runs = runs.select("run", h.alias("h")).select("run", "h", (F.col("h") % F.length("run")).cast("int").alias("at"))
    word = F.when(F.col("h") % DAMAGE == 0, F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= OCCURS)


def spread(words: DataFrame) -> DataFrame:
    """Each word in its groups: kind, m (length of the shorter word), a, b (where the edit may be), key, is_longer, word, n."""
    size = F.length("word")
    kinds = [(REPLACE, size, False), (INSERT, size, False), (INSERT, size - 1, True)]
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), m.alias("m"), F.lit(longer).alias("is_longer")) for k, m, longer in kinds))
    rows = words.select("word", "n", F.explode(kinds).alias("k")).select("word", "n", "k.*").where(F.col("m") >= LEAST)
    half = F.expr("m div 2")
    spans = F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), (F.col("m") + F.col("kind")).alias("b")))
    return keyed(rows.select("*", F.explode(spans).alias("s")).select(*rows.columns, "s.*"))


def keyed(rows: DataFrame) -> DataFrame:
    """rows with the key of their span: the code points before it and those behind it."""
    behind = F.when(F.col("is_longer"), F.col("b")).otherwise(F.col("b") - F.col("kind"))
    key = F.concat(F.expr("left(word, a)"), F.lit(" "), F.substring("word", behind + 1, F.length("word")))
    return rows.select("kind", "m", "a", "b", key.alias("key"), "is_longer", "word", "n")


def halved(rows: DataFrame) -> DataFrame:
    """rows with each half of their span."""
    middle = F.expr("(a + b) div 2")
    spans = F.array(F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), "b"))
    others = [c for c in rows.columns if c not in ("a", "b", "key")]
    return keyed(rows.select(*others, F.explode(spans).alias("s")).select(*others, "s.*"))


def grouped(words: DataFrame, most: int = MOST) -> tuple[list[DataFrame], list[DataFrame]]:
    """The rows of all groups as tables of which no group has over `most` words, but for spans of one position; and the written tables that they read."""
    out, used = [], []
    rows = spread(words)
    while True:
        sizes = rows.groupBy(*GROUP).agg(F.count("*").alias("size")).where((F.col("size") > most) & (F.col("b") - F.col("a") > 1)).drop("size")
        hot = written(sizes, "spelling-hot")
        used.append(hot)
        if hot.isEmpty():
            return [*out, rows], used
        out.append(rows.join(hot, GROUP, "left_anti"))
        rows = written(halved(rows.join(hot, GROUP, "left_semi")), "spelling-rows")
        used.append(rows)


class WaveletTree:
    """Range reporting over a permutation: one bit vector for each level, zeros before ones."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, int(len(values) - 1).bit_length()) if len(values) else 1
        self.zeros, now = [], values.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            zero = (now >> level & 1) == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(zero))).astype(np.int32))
            now = np.concatenate((now[zero], now[~zero]))

    def report(self, x: np.ndarray, x_end: np.ndarray, y: np.ndarray, y_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rectangle, value) of every value within [y, y_end) at the places [x, x_end)."""
        of, base = np.flatnonzero((x < x_end) & (y < y_end)), None
        low, high = x[of].astype(np.int64), x_end[of].astype(np.int64)
        base = np.zeros(len(of), np.int64)
        for k, zeros in enumerate(self.zeros):
            width, total = 1 << (self.levels - 1 - k), int(zeros[-1])
            low0, high0 = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            left = (low0 < high0) & (base < y_end[of]) & (base + width > y[of])
            low1, high1, base1 = total + low - low0, total + high - high0, base + width
            right = (low1 < high1) & (base1 < y_end[of]) & (base1 + width > y[of])
            of = np.concatenate((of[left], of[right]))
            low, high = np.concatenate((low0[left], low1[right])), np.concatenate((high0[left], high1[right]))
            base = np.concatenate((base[left], base1[right]))
        return of, base


def _order(words: list[str], group: np.ndarray, flat: np.ndarray, offset: np.ndarray, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each word within (group, word), and what each word shares with the one before in that order; -1 where the group begins."""
    named = [f"{g:08d}{w[::-1] if backward else w}" for g, w in zip(group.tolist(), words, strict=True)]
    order = np.array(sorted(range(len(words)), key=named.__getitem__), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    size = np.diff(offset)
    a, b = order[:-1], order[1:]
    least = np.minimum(size[a], size[b])
    to = np.concatenate(([0], np.cumsum(least)))
    step = np.arange(to[-1]) - np.repeat(to[:-1], least)
    ends = (lambda i: np.repeat(offset[i + 1] - 1, least) - step) if backward else (lambda i: np.repeat(offset[i], least) + step)
    differs = flat[ends(a)] != flat[ends(b)]
    at = np.flatnonzero(differs)
    first = np.searchsorted(at, to[:-1])
    found = np.append(at, to[-1])[first]
    shared = np.minimum(found, to[1:]) - to[:-1]
    shared[group[a] != group[b]] = -1
    return rank, np.concatenate(([-1], shared)) if len(words) else np.zeros(0, np.int64)


def _interval(shared: np.ndarray, rank: np.ndarray, length: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Targets that share `length` code points with the word at `rank`, as an interval of their places; targets: number of them before each rank."""
    low, high = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
    by = np.argsort(length, kind="stable")
    lengths, first = np.unique(length[by], return_index=True)
    for p, (i, j) in zip(lengths.tolist(), pairwise([*first.tolist(), len(by)]), strict=True):
        own = by[i:j]
        edge = np.append(np.flatnonzero(shared < p), len(shared))
        at = np.searchsorted(edge, rank[own], side="right")
        low[own], high[own] = targets[edge[at - 1]], targets[edge[at]]
    return low, high


def near(words: list[str], group: np.ndarray, kind: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, is_longer: np.ndarray, points: int = POINTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row, row of a near word), in parts: both directions, each once."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    offset = np.concatenate(([0], np.cumsum(size)))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    forward, shared_f = _order(words, group, flat, offset, False)
    backward, shared_b = _order(words, group, flat, offset, True)
    target = (kind == REPLACE) | is_longer
    in_f, in_b = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, np.int64)
    in_f[1:][forward], in_b[1:][backward] = target, target
    in_f, in_b = np.cumsum(in_f), np.cumsum(in_b)
    own = np.flatnonzero(target)
    by_f, by_b = own[np.argsort(forward[own])], own[np.argsort(backward[own])]
    tree = WaveletTree(in_b[backward[by_f]])
    asks = np.flatnonzero(~is_longer)
    positions = (b - a)[asks]
    parts = np.searchsorted(np.cumsum(positions), np.arange(points, int(positions.sum()) + points, points))
    begin = 0
    for end in [*parts.tolist(), len(asks)]:
        some = asks[begin : max(end, begin)]
        begin = max(end, begin)
        if not len(some):
            continue
        n = (b - a)[some]
        row = np.repeat(some, n)
        p = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + a[row]
        x, x_end = _interval(shared_f, forward[row], p, in_f)
        least = np.where(kind[row] == REPLACE, 2, 1)  # a word is within its own rectangle where the other has its length
        some = np.flatnonzero(x_end - x >= least)
        row, p, x, x_end, least = row[some], p[some], x[some], x_end[some], least[some]
        y, y_end = _interval(shared_b, backward[row], m[row] - p - (kind[row] == REPLACE), in_b)
        some = np.flatnonzero(y_end - y >= least)
        row, p, x, x_end, y, y_end = (v[some] for v in (row, p, x, x_end, y, y_end))
        step, at = np.minimum(x_end - x, y_end - y), 0
        while at < len(row):  # so many rectangles that their points fit
            stop = max(at + 1, at + int(np.searchsorted(np.cumsum(step[at:]), points, side="right")))
            of, value = tree.report(x[at:stop], x_end[at:stop], y[at:stop], y_end[at:stop])
            of += at
            there, here, place = by_b[value], row[of], p[of]
            inserts = kind[here] == INSERT
            # of the positions of one insertion the last one counts: there the letters differ
            last = place == size[here]
            inside = np.flatnonzero(inserts & ~last)
            last[inside] = flat[offset[here[inside]] + place[inside]] != flat[offset[there[inside]] + place[inside]]
            good = np.where(inserts, last, here != there)
            here, there, inserts = here[good], there[good], inserts[good]
            yield np.concatenate((here, there[inserts])), np.concatenate((there, here[inserts]))
            at = stop


def _summed(words: list[str], n: np.ndarray, place: np.ndarray, here: np.ndarray, there: np.ndarray) -> pa.RecordBatch:
    """The near words of each word, added up: their number, the most frequent and its number, of equal ones the first."""
    by = np.lexsort((place[there], -n[there], here))
    here, there = here[by], there[by]
    own, first, count = np.unique(here, return_index=True, return_counts=True)
    best = there[first]
    take = lambda rows: pa.array([words[i] for i in rows.tolist()], pa.string())
    return pa.RecordBatch.from_arrays([take(own), pa.array(n[own]), pa.array(count.astype(np.int64)), take(best), pa.array(n[best])], ["word", "n", "n_near", "form", "form_n"])


def _bucket(table: pa.Table) -> pa.Table:
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy().astype(np.int64)
    kind, m, a, b = (table.column(c).to_numpy().astype(np.int64) for c in ("kind", "m", "a", "b"))
    names: dict[tuple, int] = {}
    group = np.array([names.setdefault(g, len(names)) for g in zip(kind.tolist(), m.tolist(), a.tolist(), b.tolist(), table.column("key").to_pylist(), strict=True)], np.int64)
    place = np.empty(len(words), np.int64)
    place[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
    longer = table.column("is_longer").to_numpy(zero_copy_only=False).astype(bool)
    parts = [_summed(words, n, place, *found) for found in near(words, group, kind, m, a, b, longer) if len(found[0])]
    release()
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])
    return pa.Table.from_batches(parts, schema)


def variants(words: DataFrame, most: int = MOST, bucket: int = BUCKET) -> DataFrame:
    """word, n, n_near, form, form_n of a written table of words (word, n): the most frequent near word where it is frequent enough."""
    tables, used = grouped(words, most)
    buckets = max(1, -(-6 * words.count() // bucket))
    found = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("form"), F.lit(None).cast("long").alias("form_n"))
    for rows in tables:
        # words of about one length meet, so that long ones don't make many steps over short ones
        where = F.pmod(F.xxhash64(*GROUP), F.lit(buckets))
        dealt = rows.groupBy(where.alias("bucket"), F.floor(F.log2("m")).alias("long"))
        found = found.unionByName(dealt.applyInArrow(_bucket, FOUND))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))))
    out = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= MORE * F.col("n")
    out = written(out.select("word", "n", "n_near", F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-variants")
    discard(*used)
    return out


def roots(found: DataFrame) -> DataFrame:
    """word, root of every word that has a form: the last word that forms lead to. Each round doubles the way."""
    way = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = written(way.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(way)
        if longer.where("moved").isEmpty():
            return longer.drop("moved")
        way = longer


def group_variants(docs: DataFrame, most: int = MOST, bucket: int = BUCKET) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all texts."""
    words = written(counted(docs), "spelling-words")
    found = variants(words, most, bucket)
    discard(words)
    return found.join(roots(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
