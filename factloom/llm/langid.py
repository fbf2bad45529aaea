"""Language identification by nearest centroid.

A text is a vector of character n-grams (1 to 3 bytes of the lower-cased letters,
other ASCII characters as one gap), hashed to DIMS coordinates, weighted by damped
term frequency times inverse document frequency, and normalised. Each language has
up to CENTROIDS centroids from spherical k-means. A text gets the language of the
centroid of the largest cosine; `rejected` marks texts whose distance from it is
beyond that of all but a REJECT share of the fitted texts of that language.

The classifier is fitted on at most FIT_PER_LANGUAGE labelled rows per language,
those of smallest hash of their id, of the rows not held out. Everything else reads
whole texts.

Defined results: a null text, or one without a letter, is `und` with score 0 and
rejected; without any labelled row every text is `und`; a tie goes to the language
that sorts first; repeated rows are predicted each; a null doc_id counts as the
text "" for holding out; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

DIMS = 4096
CENTROIDS = 4
FIT_PER_LANGUAGE = 1000
REJECT = 0.01
HELD_OUT = 2
ROUNDS = 12

_SALTS = np.array([0x85EBCA6B, 0x0BD794D6, 0x91C36F41], np.uint32)
_GAP = np.arange(256, dtype=np.uint8)
_GAP[[c for c in range(128) if not chr(c).isalpha()]] = 0x20


def grams(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a text. Any two gaps are one, and n-grams within gaps are left out."""
    raw = _GAP[np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)]
    gap = raw == 0x20
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    keep[0] = True
    raw = raw[keep].astype(np.uint32)
    one, two = raw[1:], (raw[:-1] << np.uint32(8)) | raw[1:]
    three = (two[:-1] << np.uint32(8)) | raw[2:] if len(raw) > 2 else raw[:0]
    ids = [x * np.uint32(2654435761) + salt for x, salt in zip((one, two, three), _SALTS, strict=True)]
    return np.bincount(np.concatenate(ids) >> np.uint32(33 - DIMS.bit_length()), minlength=DIMS)


class Model:
    def __init__(self, idf: np.ndarray, names: list[str], of: np.ndarray, centroids: np.ndarray, limit: np.ndarray):
        self.idf, self.names, self.of, self.centroids, self.limit = idf, names, of, centroids, limit

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts, dtype=np.float32) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and self.names and any(map(str.isalpha, t))]
        for k in range(0, len(at), 256):
            some = at[k : k + 256]
            cosine = self.vectors(np.stack([grams(texts[i]) for i in some])) @ self.centroids.T
            best = cosine.argmax(axis=1)
            for i, b, c in zip(some, best.tolist(), cosine.max(axis=1).tolist(), strict=True):
                lang = int(self.of[b])
                out[i] = (self.names[lang], min(1.0, max(0.0, c)), bool(1 - c > self.limit[lang]))
        return out


def clusters(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k centroids of unit rows: spherical k-means from far-apart seeds, without chance."""
    seeds = [x.sum(axis=0)]
    nearest = None
    while len(seeds) <= min(k, len(x)):
        c = seeds[-1] / max(np.linalg.norm(seeds[-1]), 1e-12)
        nearest = x @ c if nearest is None or len(seeds) == 1 else np.maximum(nearest, x @ c)
        seeds.append(x[int(nearest.argmin())])
    c = np.stack(seeds[: max(1, min(k, len(x)))])
    for _ in range(rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(axis=1)
        c = np.stack([x[own == j].sum(axis=0) for j in range(len(c)) if (own == j).any()])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def remainder():
    """crc32 of doc_id as text, modulo 4."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """lang, draw, doc_id, counts (compressed) of at most per_language rows that are not held out for each language, those of smallest hash of their id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (remainder() != HELD_OUT))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # from the number of ids, a bound on the draw under which each language has a little more than it needs
    n = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
    bound = n.select("lang", F.ceil(F.lit(float(1 << 40)) * F.least(F.lit(1.0), 1.5 * per_language / F.col("n") + 20 / F.col("n"))).cast("long").alias("bound"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            counts = [zlib.compress(np.minimum(grams(t), 65535).astype("<u2").tobytes(), 1) if any(map(str.isalpha, t)) else None for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("draw"), b.column("doc_id"), pa.array(counts, pa.binary())], ["lang", "draw", "doc_id", "counts"])

    drawn = known.select("lang", "doc_id", "text", draw.alias("draw")).join(F.broadcast(bound), "lang").where("draw < bound").select("lang", "draw", "doc_id", "text")
    counted = drawn.mapInArrow(run, "lang string, draw long, doc_id long, counts binary").where("counts is not null")
    # rows of one id, however many, count as far as the number goes
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "counts"))
    return counted.withColumn("place", place).where(F.col("place") <= per_language).drop("place")


def fit(docs: DataFrame, per_language: int = FIT_PER_LANGUAGE) -> Model:
    """A model of the rows that are not held out. Document frequencies are summed and centroids found on executors, a language at a time; the driver gets the centroids, 16 KB each."""
    picked = written(sample(docs, per_language), "languages")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(DIMS, np.int64)
        for b in batches:
            for c in b.column("counts"):
                total += np.frombuffer(zlib.decompress(c.as_py()), "<u2") > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()], pa.binary())], ["n", "total"])

    parts = picked.select("counts").mapInArrow(frequencies, "n long, total binary").collect()
    if not parts:
        return Model(np.zeros(DIMS, np.float32), [], np.zeros(0, int), np.zeros((0, DIMS), np.float32), np.zeros(0))
    n, df = sum(p.n for p in parts), sum(np.frombuffer(p.total, np.int64) for p in parts)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.05)
    model = Model(idf, [], np.zeros(0, int), np.zeros((0, DIMS), np.float32), np.zeros(0))

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", "doc_id", "counts"])
        x = model.vectors(np.stack([np.frombuffer(zlib.decompress(c), "<u2") for c in pdf["counts"]]))
        c = clusters(x, CENTROIDS).astype(np.float32)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "centroids": [c.tobytes()], "farthest": [float(np.quantile(1 - (x @ c.T).max(axis=1), 1 - REJECT))]})

    found = sorted(picked.groupBy("lang").applyInPandas(centroids, "lang string, centroids binary, farthest double").collect(), key=lambda r: r.lang)
    discard(picked)
    own = [np.frombuffer(r.centroids, np.float32).reshape(-1, DIMS) for r in found]
    return Model(idf, [r.lang for r in found], np.repeat(np.arange(len(own)), [len(c) for c in own]), np.concatenate(own), np.array([r.farthest for r in found]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine), rejected for each document; only doc_id and text are read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = shared.value.predict(b.column("text").to_pylist())
            columns = [pa.array([r[i] for r in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), *columns], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", (remainder() == HELD_OUT).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
