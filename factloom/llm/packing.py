"""Packing of token sequences: first-fit decreasing with a tournament tree.

Documents are tokenised, ended by an end id, and cut into pieces of at most the
sequence length (only documents longer than a sequence are cut: full pieces and a
rest). Pieces are dealt at random into groups of about GROUP_PIECES of them. Each
group is packed on its own: pieces by decreasing length, each into the first bin
with room, which a tournament tree over the bins' free capacities finds in a
logarithmic number of steps. Groups don't depend on each other, so packing scales
with the number of groups; only lengths are shuffled unless ids are asked for.

Tokenising remembers the ids of words, for a text's ids are those of its
whitespace-separated words one after the other. Texts for which that might not hold
(a special token's string, text not in NFC, a capital sigma, control characters that
only Python takes for white space) go to the tokenizer as a whole.

Defined results: a null text counts as empty, that is the end id alone; repeated rows
are packed each; rows with a null doc_id are packed, too; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written

SEQUENCE = 4096
GROUP_PIECES = 4096
MEMO = 400_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class TournamentTree:
    """Free capacities of bins; the leftmost bin with enough room in O(log n)."""

    def __init__(self, capacity: int, leaves: int = 64):
        self.capacity, self.used, self.leaves = capacity, 0, leaves
        self.tree = [0] * (2 * leaves)

    def _set(self, leaf: int, free: int) -> None:
        at = leaf + self.leaves
        self.tree[at] = free
        while at > 1:
            at >>= 1
            best = max(self.tree[2 * at], self.tree[2 * at + 1])
            if self.tree[at] == best:
                return
            self.tree[at] = best

    def put(self, size: int) -> tuple[int, int]:
        """Bin and offset of an item; a new bin is opened where none has room."""
        tree = self.tree
        if tree[1] < size:
            if self.used == self.leaves:
                old = tree[self.leaves :]
                self.leaves *= 2
                self.tree = tree = [0] * self.leaves + old + [0] * (self.leaves - len(old))
                for at in range(self.leaves - 1, 0, -1):
                    tree[at] = max(tree[2 * at], tree[2 * at + 1])
            leaf, free = self.used, self.capacity
            self.used += 1
        else:
            at = 1
            while at < self.leaves:
                at = 2 * at if tree[2 * at] >= size else 2 * at + 1
            leaf, free = at - self.leaves, tree[at]
        self._set(leaf, free - size)
        return leaf, self.capacity - free


class WordTokenizer:
    """Ids of texts by a tokenizers file, through a bounded memory of words."""

    _whole = re.compile("<\\||[\x1c-\x1fΣ]")

    def __init__(self, path: str, memo: int = MEMO):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in splits] == ["Split", "ByteLevel"]
        if self.by_word:
            self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
            self.model = self.tokenizer.model
            # the byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on, in order
            self.alphabet, other = {}, 256
            for b in range(256):
                if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
                    self.alphabet[b] = chr(b)
                else:
                    self.alphabet[b], other = chr(other), other + 1
        self.most, self.words, self.parts = memo, {}, {}

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            text = part if part.isascii() and part.isprintable() else "".join(map(self.alphabet.__getitem__, part.encode()))
            got = np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
            if len(self.parts) >= self.most:
                self.parts.clear()
            self.parts[part] = got
        return got

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if not self.by_word or self._whole.search(text) or not unicodedata.is_normalized("NFC", text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.lower().split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            new = set(words).difference(self.words)
        if len(self.words) + len(new) > self.most:
            self.words.clear()
            new = set(words)
        for w in new:
            self.words[w] = self._part(w) if w.isalpha() and w.isascii() else b"".join(map(self._part, self.pattern.findall(w)))
        return b"".join(map(self.words.__getitem__, words))


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One of a kind in each worker process, so that its memory serves all tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenised(docs: DataFrame, path: str, end_id: int, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: PIECES, with their ids as an array if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            of, start, length, crc, total, ids = [], [], [], [], [], []
            for k, text in enumerate(b.column("text")):
                raw = words.ids(text.as_py() or "") + end
                for a in range(0, len(raw), 4 * sequence):
                    part = raw[a : a + 4 * sequence]
                    of.append(k)
                    start.append(a // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(raw) // 4)
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [b.column("doc_id").take(pa.array(of, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)
        release()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def first_fit_decreasing(lengths: np.ndarray, capacity: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first, of equal ones the first."""
    tree = TournamentTree(capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], offsets[i] = tree.put(int(lengths[i]))
    return bins, offsets


def pack(pieces: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces, a written table, with sequence_id and offset. Their number sets the number of groups, so a group has about as many pieces whatever the documents' lengths are.

    A piece's group comes from its own content and its row's place, so that copies of one document, however many, are spread, too.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    place = F.monotonically_increasing_id()
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", place), F.lit(groups)).cast("long"))

    def run(table: pa.Table) -> pa.Table:
        keys = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=keys))
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), sequence)
        group = table.column("group").to_numpy()
        return table.drop_columns(["group"]).append_column("sequence_id", pa.array(group * (1 << 32) + bins)).append_column("offset", pa.array(offsets))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("group").applyInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, end_id: int, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """Each text is tokenised once: its pieces are a table in the shared folder, which the result reads."""
    return pack(written(tokenised(docs, path, end_id, sequence, with_ids), "pieces"), sequence, group_pieces)
