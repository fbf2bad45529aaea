"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer.

Two deterministic transducers run one after the other over a stream of texts:

* `Splitter` reads classes of code points and marks where the pieces of the split pattern begin. It has eleven states,
  so a chunk of text is a map from states to states. All chunks of a block are run from all states together, their maps
  are composed by a parallel prefix scan, and each chunk is then run from the one state that it really begins in.
* `Merger` reads the bytes of a piece. Each transition has the change of the number of tokens that its byte makes, so
  the sum along a piece is the number of its tokens. A state is what the merges can still depend on: the places behind
  the current one where a token may have begun that still can grow (a chain of suffix links in the trie of all tokens),
  and for each the last token before it and the tokens counted since. States and transitions are compiled when a text
  first asks for them and kept for the next; all pieces of a block step together through an open-addressing table.

The last token of a prefix is the one suffix token that stays apart from the last token before it; two tokens stay
apart if no merge joins a part at the right edge of one and a part at the left edge of the other while both are there.

Nothing is estimated, and memory follows a block of BLOCK bytes: between blocks the splitter's state, the merger's
state and one character are carried, so that a text or a piece may be of any length.

Defined results: a null text counts as empty and has 0 tokens; repeated rows are counted each; ids, null ones too, come
back as they were; an empty table gives no rows; further columns are ignored. Special strings within a text count as
one token and part the text, as the library has it by default.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches, release, text_buffer

#: Tokens that a text may have.
LIMIT = 1024
#: Bytes that are stepped together, and code points of a chunk whose map is worked out.
BLOCK, CHUNK = 1 << 18, 32
#: Compiled states at which the merger begins anew before the next block.
MOST_STATES = 400_000
#: Between texts, and for special strings: a byte that UTF-8 doesn't have.
END = 0xFF

LETTER, SOLO, PAIR_E, PAIR_L, LETTER_E, DIGIT, QUOTE, OTHER, BLANK, SPACE, STOP = range(11)
FRESH, LETTERS, DIGITS, OTHERS, QUOTED, WANTS_E, WANTS_L, ONE_BLANK, ONE_SPACE, END_BLANK, END_SPACE = range(11)


def _splitter() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next state, whether a piece begins at this character, and whether one begins at the one before, by state and class."""
    to, here, before = (np.zeros((11, 11), np.uint8) for _ in range(3))
    letters, marks, white = (LETTER, SOLO, PAIR_E, PAIR_L, LETTER_E), (QUOTE, OTHER), (BLANK, SPACE)
    begin = {**dict.fromkeys(letters, LETTERS), DIGIT: DIGITS, QUOTE: QUOTED, OTHER: OTHERS, BLANK: ONE_BLANK, SPACE: ONE_SPACE, STOP: FRESH}
    to[:], here[:] = [begin[c] for c in range(11)], 1

    def stays(state: int, classes, next_state: int, earlier: int = 0) -> None:
        for c in classes:
            to[state, c], here[state, c], before[state, c] = next_state, 0, earlier

    stays(LETTERS, letters, LETTERS)
    stays(DIGITS, [DIGIT], DIGITS)
    stays(OTHERS, marks, OTHERS)
    # 's 't 'm 'd and 're 've 'll are pieces where a piece begins at the quote
    stays(QUOTED, marks, OTHERS)
    stays(QUOTED, [SOLO], FRESH)
    stays(QUOTED, [PAIR_E], WANTS_E)
    stays(QUOTED, [PAIR_L], WANTS_L)
    before[WANTS_E], before[WANTS_L] = 1, 1
    for state, last in ((WANTS_E, LETTER_E), (WANTS_L, PAIR_L)):
        stays(state, letters, LETTERS, 1)
        stays(state, [last], FRESH)
    # the last of several white characters before anything else begins a piece, and a blank one goes on with it
    for state, several in ((ONE_BLANK, False), (END_BLANK, True), (ONE_SPACE, False), (END_SPACE, True)):
        if several:
            before[state, : STOP] = 1
        stays(state, [BLANK], END_BLANK)
        stays(state, [SPACE], END_SPACE)
        if state in (ONE_BLANK, END_BLANK):
            stays(state, letters, LETTERS, several)
            stays(state, [DIGIT], DIGITS, several)
            stays(state, marks, OTHERS, several)
    return to, here, before


TO, HERE, BEFORE = _splitter()


def character_runs(path: str) -> list[tuple[int, int]]:
    """(first code point, class) of each run of code points of one class, as the tokenizer's own split pattern has them."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    whole = lambda a, c: any(e - s == 3 for _, (s, e) in split(a + c + a))
    runs: list[tuple[int, int]] = []
    for low in range(0, 0x110000, 1 << 14):
        points = [c for c in range(low, low + (1 << 14)) if not 0xD800 <= c < 0xE000 and c not in (0x20, 0x27)]
        if not points:
            continue
        for _, (a, _) in split("".join(map(chr, points))):
            c = chr(points[a])
            runs.append((points[a], LETTER if whole("a", c) else DIGIT if whole("1", c) else OTHER if whole("!", c) else SPACE))
    return runs


def class_table(runs: list[tuple[int, int]]) -> np.ndarray:
    """The class of every code point; of 0x110000, which stands for an end, too."""
    first, kind = np.array(runs).T
    out = np.repeat(kind.astype(np.uint8), np.diff(np.append(first, 0x110001)))
    out = np.concatenate((np.full(first[0], OTHER, np.uint8), out))
    for chars, c in (("stmd", SOLO), ("rv", PAIR_E), ("l", PAIR_L), ("e", LETTER_E), ("'", QUOTE), (" ", BLANK)):
        out[[ord(x) for x in chars]] = c
    out[0x110000] = STOP
    return out


def piece_starts(classes: np.ndarray, state: int, chunk: int = CHUNK) -> tuple[np.ndarray, int, bool]:
    """Where pieces begin, the state at the end, and whether one begins at the character before the first."""
    n = len(classes)
    lanes = -(-n // chunk)
    padded = np.full(lanes * chunk, STOP, np.uint8)
    padded[:n] = classes
    steps = np.ascontiguousarray(padded.reshape(lanes, chunk).T)
    maps = np.tile(np.arange(11, dtype=np.uint8), (lanes, 1))
    flat = TO.ravel()
    for c in steps:
        maps = flat[maps * np.uint8(11) + c[:, None]]
    shift = 1
    while shift < lanes:  # maps[i] becomes the map of all chunks up to i
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift].copy(), axis=1)
        shift *= 2
    now = np.concatenate(([np.uint8(state)], maps[:-1, state]))
    here, before = np.empty((chunk, lanes), np.uint8), np.empty((chunk, lanes), np.uint8)
    last = state
    for k, c in enumerate(steps):
        at = now * np.uint8(11) + c
        here[k], before[k], now = HERE.ravel()[at], BEFORE.ravel()[at], flat[at]
        if k == (n - 1) % chunk:
            last = int(now[-1])
    starts, earlier = here.T.ravel()[:n].astype(bool), before.T.ravel()[:n].astype(bool)
    starts[:-1] |= earlier[1:]
    return starts, last, bool(earlier[0]) if n else False


class Merger:
    """The transducer over the bytes of pieces."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[int, int, int]]):
        """merges: (left, right, joined) ids in order of rank."""
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(merges)}
        self.parts = {t: (a, b) for a, b, t in merges}
        made = {t: r for r, (_, _, t) in enumerate(merges)}
        if len(made) != len(merges) or any(max(made.get(a, -1), made.get(b, -1)) >= r for r, (a, b, _) in enumerate(merges)):
            raise ValueError("every token must come from one merge of tokens that are made before")
        self.made = made
        # the trie of all tokens with suffix links
        self.child: dict[int, int] = {}
        self.depth, self.token, self.grows = [0], [-1], [False]
        for word, t in vocabulary.items():
            v = 0
            for c in word:
                w = self.child.get(v << 8 | c)
                if w is None:
                    w = self.child[v << 8 | c] = len(self.depth)
                    self.depth.append(self.depth[v] + 1)
                    self.token.append(-1)
                    self.grows.append(False)
                    self.grows[v] = True
                v = w
            self.token[v] = t
        self.link = [0] * len(self.depth)
        for key, w in sorted(self.child.items(), key=lambda x: self.depth[x[1]]):
            if key >> 8:
                self.link[w] = self._go(self.link[key >> 8], key & 255)
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}
        self._alone: dict[int, bool] = {}
        self._apart: dict[int, bool] = {}
        self.begin()

    def begin(self) -> None:
        """Forgets what is compiled but the first state."""
        # a state: its node in the trie, then for each place its distance, the last token before it and the tokens since
        self.states: list[tuple[int, ...]] = [(0, 0, -1, 0)]
        self.known: dict[tuple[int, ...], int] = {self.states[0]: 0}
        self._table(1 << 16)

    def _table(self, size: int) -> None:
        self.keys, self.next, self.delta, self.used = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32), 0

    def _go(self, v: int, c: int) -> int:
        while True:
            w = self.child.get(v << 8 | c)
            if w is not None:
                return w
            if not v:
                return 0
            v = self.link[v]

    def _edge(self, t: int, side: int) -> list[tuple[int, float]]:
        """The parts at one edge of a token, each with the rank of the merge that takes it up."""
        kept = self._right if side else self._left
        if t not in kept:
            out, until = [], float("inf")
            x: int | None = t
            while x is not None:
                out.append((x, until))
                until = self.made.get(x, -1)
                x = self.parts[x][side] if x in self.parts else None
            kept[t] = out
        return kept[t]

    def _joins(self, a: int, b: int, most: float) -> bool:
        """Whether a merge of a rank under `most` joins the tokens' edges. Of equal ranks the one further left comes first."""
        for x, x_until in self._edge(a, 1):
            for y, y_until in self._edge(b, 0):
                r = self.rank.get((x, y))
                if r is not None and r < x_until and r <= y_until and r < most:
                    return True
        return False

    def alone(self, t: int) -> bool:
        """Whether the token's own bytes give the token."""
        got = self._alone.get(t)
        if got is None:
            if t not in self.parts:
                got = True
            else:
                a, b = self.parts[t]
                got = self.alone(a) and self.alone(b) and not self._joins(a, b, self.made[t])
            self._alone[t] = got
        return got

    def apart(self, a: int, b: int) -> bool:
        if a < 0:
            return True
        key = a << 32 | b
        got = self._apart.get(key)
        if got is None:
            if len(self._apart) >= 4 * MOST_STATES:
                self._apart.clear()
            got = self._apart[key] = not self._joins(a, b, float("inf"))
        return got

    def _compile(self, state: int, c: int) -> tuple[int, int]:
        key = self.states[state]
        places = {key[i]: (key[i + 1], key[i + 2]) for i in range(1, len(key), 3)}
        v = u = self._go(key[0], c)
        while True:
            t = self.token[u]
            if t >= 0 and self.alone(t):
                last, since = places[self.depth[u] - 1]
                if self.apart(last, t):
                    break
            if not u:
                raise ValueError(f"byte {c} has no token")
            u = self.link[u]
        delta = since + 1
        while v and not self.grows[v]:
            v = self.link[v]
        new, u = [v, 0, t, 0], v
        while u:
            if self.grows[u]:
                last, since = places[self.depth[u] - 1]
                new += (self.depth[u], last, since - delta)
            u = self.link[u]
        key = tuple(new)
        to = self.known.get(key)
        if to is None:
            to = self.known[key] = len(self.states)
            self.states.append(key)
        return to, delta

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key: where it is, or the empty one where it would go."""
        mask = len(self.keys) - 1
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & mask
        there = self.keys[at]
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & mask
            there = self.keys[at[open_]]
            open_ = open_[(there != keys[open_]) & (there >= 0)]
        return at

    def _put(self, keys: np.ndarray, to: np.ndarray, delta: np.ndarray) -> None:
        left = np.arange(len(keys))
        while len(left):  # of several keys for one slot one goes in and the others look on
            at = self._slots(keys[left])
            _, one = np.unique(at, return_index=True)
            self.keys[at[one]], self.next[at[one]], self.delta[at[one]] = keys[left[one]], to[left[one]], delta[left[one]]
            left = np.delete(left, one)
        self.used += len(keys)

    def step(self, states: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and changes of the number of tokens."""
        keys = states.astype(np.int64) << 8 | chars
        at = self._slots(keys)
        missing = np.flatnonzero(self.keys[at] < 0)
        if len(missing):
            new = np.unique(keys[missing])
            made = np.array([self._compile(int(k) >> 8, int(k) & 255) for k in new], np.int32)
            if 2 * (self.used + len(new)) > len(self.keys):
                full = self.keys >= 0
                old = self.keys[full], self.next[full], self.delta[full]
                self._table(1 << int(4 * (self.used + len(new))).bit_length())
                self._put(*old)
            self._put(new, made[:, 0], made[:, 1])
            at = self._slots(keys)
        return self.next[at], self.delta[at]

    def run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """Sum of the changes along each span of data. The first span begins in `state`, all others in the first one; also the last span's last state."""
        n = len(start)
        size = end - start
        order = np.argsort(-size, kind="stable")
        at, live = start[order], size[order]
        states, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if n:
            states[np.flatnonzero(order == 0)] = state
        many, k = n, 0
        while many:
            while many and live[many - 1] <= k:
                many = int(np.searchsorted(-live, -k, side="left"))
            if not many:
                break
            states[:many], delta = self.step(states[:many], data[at[:many] + k])
            total[:many] += delta
            k += 1
        out = np.empty(n, np.int64)
        out[order] = total
        return out, int(states[np.flatnonzero(order == n - 1)[0]]) if n else state


class TokenCounter:
    """Both transducers and the special strings of a tokenizer file."""

    def __init__(self, path: str, runs: list[tuple[int, int]]):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, split = made["model"], made["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or made["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("only byte-level BPE with its own split pattern can be compiled")
        special = made["added_tokens"]
        if any(x[k] for x in special for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("special strings that take up white space or ask for whole words can't be compiled")
        # the byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on, in order
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}
        raw = lambda t: bytes(byte[c] for c in t)
        added = {x["content"] for x in special}
        ids = {t: i for t, i in model["vocab"].items() if t not in added}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merger = Merger({raw(t): i for t, i in ids.items()}, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        found = sorted((x["content"].encode() for x in special if x["content"]), key=lambda s: (-len(s), s))
        self.special = re.compile(b"|".join(map(re.escape, found))) if found else None
        self.classes = class_table(runs)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a buffer."""
        stream, marks, extra = self._stream(data, offsets)
        total = np.bincount(extra, minlength=len(offsets) - 1).astype(np.int64)
        state, merge_state, held, held_starts = FRESH, 0, np.zeros(0, np.uint8), False
        a = 0
        while a < len(stream):
            if len(self.merger.states) > MOST_STATES:
                merge_state = self._afresh(merge_state)
            b = min(len(stream), a + BLOCK)
            while b < len(stream) and stream[b] & 0xC0 == 0x80:
                b += 1
            block = stream[a:b]
            lead = np.flatnonzero((block & 0xC0) != 0x80)
            kinds = self.classes[code_points(block, lead)]
            starts, state, earlier = piece_starts(kinds, state)
            # the character held back may begin a piece after all; the block's last one is held back in turn
            held_starts |= earlier
            chars = np.concatenate((held, block))
            first = len(held)
            at = np.concatenate((np.zeros(1 if first else 0, np.int64), lead + first))
            flags = np.concatenate((np.full(1 if first else 0, held_starts, bool), starts))
            stops = np.concatenate((np.full(1 if first else 0, first == 1 and chars[0] == END, bool), kinds == STOP))
            whole = at[-1] if b < len(stream) else len(chars)
            start = at[flags & (at < whole)]
            open_ = not len(start) or start[0] > 0
            start = np.concatenate((np.zeros(1 if open_ else 0, np.int64), start))
            end = np.append(start[1:], whole)
            ends = np.zeros(len(chars) + 1, bool)
            ends[at[stops]] = True
            real = ~ends[start] & (end > start)
            origin = a - first
            sums, last = self.merger.run(chars, start[real], end[real], merge_state if open_ and len(real) and real[0] else 0)
            total += np.bincount(np.searchsorted(marks, origin + start[real], side="right"), weights=sums, minlength=len(total)).astype(np.int64)[: len(total)]
            merge_state = last if len(real) and real[-1] else 0
            held, held_starts = chars[whole:], bool(flags[-1])
            a = b
        return total

    def _afresh(self, state: int) -> int:
        """The merger begins anew; the state of the open piece is kept."""
        keep = self.merger.states[state]
        self.merger.begin()
        if not state:
            return 0
        self.merger.known[keep] = 1
        self.merger.states.append(keep)
        return 1

    def _stream(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts with an end after each and in place of each special string, the places of the texts' ends, and the text of each special string."""
        n = len(offsets) - 1
        stream = np.insert(data, offsets[1:], np.uint8(END))
        marks = offsets[1:] + np.arange(n)
        spans = [m.span() for m in self.special.finditer(stream.tobytes())] if self.special else []
        if not spans:
            return stream, marks, np.zeros(0, np.int64)
        begin, end = np.array(spans).T
        extra = np.searchsorted(marks, begin)
        gone = np.zeros(len(stream) + 1, np.int64)
        np.add.at(gone, begin + 1, 1)
        np.add.at(gone, end, -1)
        gone = np.cumsum(gone)[:-1] > 0
        stream = stream.copy()
        stream[begin] = END
        return stream[~gone], marks - np.cumsum(gone)[marks], extra


def code_points(block: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The code points that begin at the leading bytes; 0x110000 for an end."""
    padded = np.concatenate((block, np.zeros(3, np.uint8))).astype(np.uint32)
    c = padded[lead]
    out = c.copy()
    long_ = np.flatnonzero(c >= 0x80)
    if len(long_):
        at, x = lead[long_], c[long_]
        b1, b2, b3 = (padded[at + i] & 0x3F for i in (1, 2, 3))
        value = np.where(x < 0xE0, (x & 0x1F) << 6 | b1, np.where(x < 0xF0, (x & 0xF) << 12 | b1 << 6 | b2, (x & 7) << 18 | b1 << 12 | b2 << 6 | b3))
        out[long_] = np.where(x == END, 0x110000, np.minimum(value, 0x10FFFF))
    return out


_counters: dict[str, TokenCounter] = {}


def counter(path: str, runs: list[tuple[int, int]]) -> TokenCounter:
    """One of a kind in each worker process: what is compiled serves all its tasks."""
    if path not in _counters:
        _counters[path] = TokenCounter(path, runs)
    return _counters[path]


def count(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text."""
    runs = character_runs(path)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = counter(path, runs)
        for batch in found:
            column = batch.column("text")
            for a, b in batches(column):
                data, offsets = text_buffer(column.slice(a, b - a))
                n = both.counts(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
