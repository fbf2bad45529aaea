"""Quality rules and line sequence labelling.

A linear-chain conditional random field labels each line with a word as content
or boilerplate; Viterbi decoding finds the best label sequence of the whole text;
the share of word characters in content lines decides retention.

Node and transition weights are fitted together by forward-backward on labelled
documents. The quality of a document is taken as a noisy observation of each of its
lines, wrong with probability LINE_NOISE, so the labels of lines are hidden: the gradient
of the likelihood is the difference of the expected features with and without the
observations, which two passes over each sequence give. A ridge keeps weights finite.
The sample is bounded: of the labelled documents the FIT_DOCS of smallest hash are read,
their sequences are cut into pieces of PIECE_LINES lines, and the FIT_PIECES of
smallest hash are fitted; with fewer than LEAST_OF_CLASS in one of the classes PRIOR holds. Weights are rounded
to thousandths, so that decoding is exact.

Defined results: a null text counts as empty (no words, so it fails the base
rules); a text without lines to label has content share 0; repeated rows are
judged each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

FIT_DOCS = 4000
FIT_PIECES = 4000
PIECE_LINES = 64
LINE_NOISE = 0.1
STEPS = 120
LEAST_OF_CLASS = 10
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
FEATURES = ("bias", "short", "long", "some symbols", "many symbols", "shouting", "exclamations", "no sentence end", "digits", "seen before", "few distinct words", "neighbours equal", "long words")
#: Node weights (content over boilerplate, in thousandths) where nothing can be fitted.
PRIOR = (2000, -300, 300, -1500, -2500, -2500, -2000, -300, -800, -2500, -2500, -2500, -500)
PRIOR_STAY = 1000

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_MARKS = SYMBOLS.encode()


def line_mask(line: bytes, words: list[bytes], seen: bool) -> int:
    """The features of a line as bits, bit 0 the bias."""
    n, size = len(words), len(line)
    without = lambda cut: size - len(line.translate(None, cut))
    marks, letters = without(_MARKS), without(_LETTERS)
    distinct = len(set(words))
    flags = (
        True, n < 4, n >= 20, 0 < marks * 5 < n, marks * 5 >= n and marks > 0, letters > 0 and 2 * without(_UPPER) > letters, line.count(b"!") * 5 > n,
        line.rstrip()[-1:] not in (b".", b"?", b"!", b":", b'"'), without(_DIGITS) * 5 > size, seen, n >= 8 and 2 * distinct < n,
        n >= 4 and sum(a == b for a, b in zip(words, words[1:], strict=False)) * 5 > n if distinct < n else False, size > 12 * n,
    )
    out = 0
    for k, f in enumerate(flags):
        out |= bool(f) << k
    return out


def lines_of(raw: bytes) -> tuple[list[int], list[int], int]:
    """Masks and word bytes of the lines with a word, and how many equal an earlier one."""
    masks, sizes, seen, repeated = [], [], set(), 0
    for line in raw.split(b"\n"):
        words = line.split()
        if words:
            again = line in seen
            repeated += again
            seen.add(line)
            masks.append(line_mask(line, words, again))
            sizes.append(sum(map(len, words)))
    return masks, sizes, repeated


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = reach = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def viterbi(masks: list[int], node: dict[int, int], stay: int) -> list[bool]:
    """The best labels (True: content); a tie goes to content. Score: node weights of content lines, plus stay for each equal pair of neighbours."""
    best_no, best_yes, back = 0, 0, []
    for k, m in enumerate(masks):
        if k == 0:
            best_yes = node[m]
            continue
        yes_from_yes, no_from_no = best_yes + stay >= best_no, best_no + stay > best_yes
        back.append((no_from_no, yes_from_yes))
        best_no, best_yes = (best_no + stay if no_from_no else best_yes), (best_yes + stay if yes_from_yes else best_no) + node[m]
    if not masks:
        return []
    out = [best_yes >= best_no]
    for no_from_no, yes_from_yes in reversed(back):
        out.append(yes_from_yes if out[-1] else not no_from_no)
    return out[::-1]


class Weights(dict):
    """Node weight of a mask, worked out when first asked for."""

    def __init__(self, weights):
        super().__init__()
        self.weights = tuple(int(w) for w in weights)

    def __missing__(self, mask: int) -> int:
        self[mask] = sum(w for k, w in enumerate(self.weights) if mask >> k & 1)
        return self[mask]


class Chains:
    """Sequences of line features of one sample, for forward-backward passes over all of them at once."""

    def __init__(self, masks: list[tuple[int, ...]], quality: list[int]):
        self.length = np.array([len(m) for m in masks])
        most = int(self.length.max())
        padded = np.array([[*m, *[0] * (most - len(m))] for m in masks], np.int64)
        self.valid = np.arange(most) < self.length[:, None]
        # the different masks, and which of them each line has
        self.kinds, self.which = np.unique(padded, return_inverse=True)
        self.which = self.which.reshape(padded.shape)
        self.features = (self.kinds[:, None] >> np.arange(len(FEATURES)) & 1).astype(float)
        self.good = np.array(quality) == 1
        lines = [max(1, int(self.length[self.good == g].sum())) for g in (False, True)]
        # either class weighs as much as 1000 lines
        self.weight = np.where(self.good, 1000 / lines[1], 1000 / lines[0])

    def expected(self, weights: np.ndarray, observed: bool) -> tuple[float, np.ndarray, float]:
        """Log of the partition function (with or without the observations of quality), and expected node features and equal neighbours; each weighted."""
        node = np.exp(self.features @ weights[:-1])[self.which]
        stay = np.exp(weights[-1])
        no, yes = np.ones_like(node), node
        if observed:
            right, wrong = 1 - LINE_NOISE, LINE_NOISE
            no, yes = np.where(self.good, wrong, right)[:, None] * no, np.where(self.good, right, wrong)[:, None] * yes
        n, most = node.shape
        forward, scale = np.zeros((most, 2, n)), np.ones((most, n))
        a, b = no[:, 0], yes[:, 0]
        for t in range(most):
            if t:
                a, b = (a * stay + b) * no[:, t], (a + b * stay) * yes[:, t]
            total = np.where(self.valid[:, t], a + b, 1.0)
            a, b = a / total, b / total
            forward[t], scale[t] = (a, b), total
        gamma, same = np.zeros((n, most)), np.zeros(n)
        c, d = np.ones(n), np.ones(n)
        for t in range(most - 1, -1, -1):
            live = self.valid[:, t]
            gamma[live, t] = (forward[t, 1] * d)[live]
            if t:
                a, b = forward[t - 1]
                x, y = no[:, t] * c / scale[t], yes[:, t] * d / scale[t]
                same += np.where(live, stay * (a * x + b * y), 0.0)
                c, d = np.where(live, stay * x + y, c), np.where(live, x + stay * y, d)
        by_kind = np.bincount(self.which.ravel(), weights=(gamma * self.weight[:, None] * self.valid).ravel(), minlength=len(self.kinds))
        log_z = float((np.log(scale) * self.valid.T).sum(axis=0) @ self.weight)
        return log_z, by_kind @ self.features, float(same @ self.weight)

    def objective(self, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """The penalised log likelihood of the observations, and its gradient."""
        z1, f1, s1 = self.expected(weights, True)
        z0, f0, s0 = self.expected(weights, False)
        return z1 - z0 - 0.5 * float(weights @ weights), np.append(f1 - f0, s1 - s0) - weights


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_pieces: int = FIT_PIECES) -> tuple[tuple[int, ...], int]:
    """Node weights and the weight of staying, in thousandths."""
    picked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, quality, masks = [], [], []
            for k, text in enumerate(b.column("text")):
                own = lines_of((text.as_py() or "").encode())[0]
                for a in range(0, len(own), PIECE_LINES):
                    doc.append(k)
                    quality.append(b.column("quality")[k].as_py())
                    masks.append(own[a : a + PIECE_LINES])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(quality, pa.int32()), pa.array(masks, pa.list_(pa.int32()))], ["doc_id", "quality", "masks"])

    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
    pieces = rows.mapInArrow(run, "doc_id long, quality int, masks array<int>")
    sample = sorted((r.quality, tuple(r.masks)) for r in pieces.orderBy(F.xxhash64("doc_id", "masks"), "doc_id", "masks").limit(fit_pieces).collect())
    if min(sum(q == 0 for q, _ in sample), sum(q == 1 for q, _ in sample)) < LEAST_OF_CLASS:
        return PRIOR, PRIOR_STAY
    chains = Chains([m for _, m in sample], [q for q, _ in sample])
    # ascent by signs: a weight's step grows while its gradient keeps its sign and halves where it turns
    weights, step, last = np.zeros(len(FEATURES) + 1), np.full(len(FEATURES) + 1, 0.2), np.zeros(len(FEATURES) + 1)
    for _ in range(STEPS):
        slope = chains.objective(weights)[1]
        turn = slope * last
        step = np.clip(np.where(turn > 0, step * 1.2, np.where(turn < 0, step * 0.5, step)), 1e-4, 1.0)
        weights += np.sign(slope) * step
        last = np.where(turn < 0, 0.0, slope)
    return tuple(int(w) for w in np.rint(weights[:-1] * 1000)), int(np.rint(weights[-1] * 1000))


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"


def judge_text(text: str | None, node: dict[int, int], stay: int, min_share: float = MIN_CONTENT_SHARE) -> tuple:
    """All columns of SCHEMA after doc_id."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    repeated = repeat_words(words)
    masks, sizes, dup = lines_of(raw)
    labels = viterbi(masks, node, stay)
    total, content = sum(sizes), sum(s for s, y in zip(sizes, labels, strict=True) if y)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    share = content / total if total else 0.0
    return n, len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(map(text.count, SYMBOLS)), dup, repeated, failed, not failed and share >= min_share, len(masks), sum(labels), share


def judge(docs: DataFrame, weights, stay: int, min_share: float = MIN_CONTENT_SHARE, keep_rows: bool = False) -> DataFrame:
    """A row of SCHEMA for each document; with keep_rows the kept documents themselves, with all their columns."""
    fields = [f.split() for f in SCHEMA.split(", ")][1:]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = Weights(weights)
        for b in batches:
            found = [judge_text(t.as_py(), node, stay, min_share) for t in b.column("text")]
            if keep_rows:
                yield b.filter(pa.array([r[6] for r in found], pa.bool_()))
            else:
                columns = [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*found, strict=True), fields, strict=True)] if found else [pa.array([], kinds[k]) for _, k in fields]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", *(n for n, _ in fields)])
        release()

    return docs.mapInArrow(run, docs.schema) if keep_rows else docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
