"""Inner products in blocks: a matrix product over an Arrow batch for a block of queries, and what is kept of it.

A product of matrices only chooses candidates: sums of doubles in another order may differ in the last digits, so whatever
is within a margin of a bound is scored again in the order of the elements before anything is decided.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scores that are held at a time, and rows that a block of queries may keep in a task.
CELLS, KEPT = 1 << 22, 100_000
#: Pairs of a row and a query that are scored again at a time, however many are near a bound.
AT_ONCE = 1 << 15


def matrix(column, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, vectors in doubles) of a list column: the rows whose vector has `dims` elements, none of them null; without dims the first row's number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    if dims is None:
        dims = int(size.max(initial=0))
    rows = np.flatnonzero(size == dims)
    if not len(rows) or not dims:
        return rows[:0], np.zeros((0, dims))
    kept = column if len(rows) == len(column) else column.take(pa.array(rows))
    values = kept.flatten()
    if values.null_count:
        whole = ~values.is_null().to_numpy(zero_copy_only=False).reshape(-1, dims).any(axis=1)
        rows, values = rows[whole], kept.take(pa.array(np.flatnonzero(whole))).flatten()
    return rows, values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def in_order(a: np.ndarray, b: np.ndarray, digits: int | None) -> np.ndarray:
    """Inner products of rows, summed from the first element to the last, and rounded."""
    out = np.cumsum(a * b, axis=1)[:, -1] if a.shape[1] else np.zeros(len(a))
    return out if digits is None else np.round(out, digits)


def inner(a: Column, b: Column) -> Column:
    """Inner product of two array columns, row by row in Arrow batches; null where lengths differ or anything is null."""

    @F.arrow_udf("double")
    def product(x: pa.Array, y: pa.Array) -> pa.Array:
        out = np.full(len(x), np.nan)
        sizes = pc.fill_null(pc.list_value_length(x), -1).to_numpy(zero_copy_only=False)
        for dims in np.unique(sizes[sizes > 0]).tolist():
            (i, v), (j, w) = matrix(x, dims), matrix(y, dims)
            both, vi, wi = np.intersect1d(i, j, return_indices=True)
            out[both] = in_order(v[vi], w[wi], None)
        return pa.array(out, mask=np.isnan(out))

    return product(a, b)


class Queries:
    """A block of queries on the driver, whose size its caller has checked: ids as they are, vectors as a matrix."""

    def __init__(self, rows: pa.Table):
        sizes = pc.fill_null(pc.list_value_length(rows.column("query")), 0).to_numpy(zero_copy_only=False)
        self.dims = int(sizes.max(initial=0))
        at, self.vectors = matrix(rows.column("query"), self.dims)
        self.ids = rows.column("query_id").combine_chunks().take(pa.array(at)) if len(rows) else rows.column("query_id").combine_chunks()
        self.lengths = np.sqrt((self.vectors**2).sum(axis=1))

    def __len__(self) -> int:
        return len(self.ids)


def collected(queries: DataFrame) -> Queries:
    return Queries(queries.select("query_id", "query").toArrow())


def parts(batch: pa.RecordBatch, dims: int, n_queries: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their vectors) in parts whose scores with all queries fit."""
    rows, vectors = matrix(batch.column("embedding"), dims)
    step = max(1, CELLS // max(1, n_queries))
    for a in range(0, len(rows), step):
        yield rows[a : a + step], vectors[a : a + step]


def margin(queries: Queries, vectors: np.ndarray, digits: int | None) -> np.ndarray:
    """Per query how far a product may be from the rounded score, twice over."""
    longest = float(np.sqrt((vectors**2).sum(axis=1).max(initial=0)))
    return 2e-12 * queries.lengths * longest + (0 if digits is None else 2 * 10.0**-digits)


def leaves(column) -> list:
    """The columns by which a column is ordered: the fields of a struct, or itself."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_struct(column.type):
        return [column]
    return [leaf for i in range(column.type.num_fields) for leaf in leaves(pc.struct_field(column, i))]


class Best:
    """The k best rows of each query so far. Rows beyond the k-th are dropped whenever too many are held."""

    def __init__(self, queries: Queries, k: int, tie: str, digits: int | None):
        self.queries, self.k, self.tie, self.digits = queries, k, tie, digits
        self.least = np.full(len(queries), -np.inf)
        self.held: list[pa.Table] = []
        self.rows = 0

    def add(self, batch: pa.RecordBatch, allowed: np.ndarray | None = None, of: np.ndarray | None = None) -> None:
        """allowed: for each row of the batch and each query whether they may meet; of: the queries that its rows meet at all."""
        q = self.queries
        of = np.arange(len(q)) if of is None else of
        asked, others = q.vectors[of], batch.select([c for c in batch.schema.names if c != "embedding"])
        for rows, vectors in parts(batch, q.dims, len(of)):
            scores, wide = vectors @ asked.T, margin(q, vectors, self.digits)[of]
            if allowed is not None:
                scores[~allowed[np.ix_(rows, of)]] = -np.inf
            near = (scores >= self.least[of] - wide) & (scores > -np.inf)
            if len(rows) > self.k and np.count_nonzero(near) > 2 * self.k * len(of):
                near &= scores >= np.partition(scores, len(rows) - self.k, axis=0)[len(rows) - self.k] - wide
            r, at = np.nonzero(near)
            for a in range(0, len(r), AT_ONCE):
                i, j = r[a : a + AT_ONCE], at[a : a + AT_ONCE]
                still = scores[i, j] >= self.least[of[j]] - wide[j]
                i, j = i[still], of[j[still]]
                exact = in_order(vectors[i], q.vectors[j], self.digits)
                self.held.append(pa.Table.from_batches([others.take(pa.array(rows[i]))]).append_column("score", pa.array(exact)).append_column("_of", pa.array(j)))
                self.rows += len(i)
                if self.rows > 2 * self.k * len(q) + 1000:
                    self.compact()

    def compact(self) -> None:
        if not self.rows:
            return
        every = pa.concat_tables(self.held)
        keys = [("_of", "ascending"), ("score", "descending")] + [(f"_{i}", "ascending") for i in range(len(leaves(every.column(self.tie))))]
        order = pa.table({"_of": every.column("_of"), "score": every.column("score")} | {f"_{i}": c for i, c in enumerate(leaves(every.column(self.tie)))})
        by = pc.sort_indices(order, sort_keys=keys, null_placement="at_start").to_numpy()
        of = every.column("_of").to_numpy()[by]
        first = np.searchsorted(of, of)
        place = np.arange(len(of)) - first
        every = every.take(pa.array(by[place < self.k]))
        full = place == self.k - 1
        self.least[of[full]] = order.column("score").to_numpy()[by[full]]
        self.held, self.rows = [every], len(every)

    def result(self) -> Iterator[pa.RecordBatch]:
        self.compact()
        for table in self.held:
            ids = self.queries.ids.take(table.column("_of").combine_chunks())
            out = table.drop_columns(["_of"]).add_column(0, "query_id", ids)
            yield from out.to_batches(max_chunksize=10_000)


def fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def partial_top_k(queries: DataFrame, vectors: DataFrame, k: int, tie: str, digits: int | None, meet: pa.Table | None = None) -> DataFrame:
    """query_id, the vectors' other columns, score: at most k rows a query a task, the best of the task. The queries are a block of checked size.

    meet: which query_id goes with which values of some of the vectors' columns, of checked size, too; without it all go with all.
    """
    block = collected(queries)
    by = [] if meet is None else [c for c in meet.column_names if c != "query_id"]
    places: dict[tuple, np.ndarray] = {}
    if meet is not None:
        at = {x: i for i, x in enumerate(block.ids.to_pylist())}
        listed: dict[tuple, set[int]] = {}
        for query_id, *key in zip(*(meet.column(c).to_pylist() for c in ("query_id", *by)), strict=True):
            if query_id in at and None not in key:
                listed.setdefault(tuple(key), set()).add(at[query_id])
        places = {key: np.array(sorted(x)) for key, x in listed.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(block, k, tie, digits)
        for b in batches:
            if meet is None:
                best.add(b)
                continue
            own: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in by), strict=True)):
                if key in places:
                    own.setdefault(key, []).append(i)
            for key, rows in own.items():
                best.add(b.take(pa.array(rows)), of=places[key])
        yield from best.result()

    others = vectors.drop("embedding")
    kind = queries.schema["query_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"query_id {kind}, {fields(others)}, score double")


def ahead(queries: DataFrame, hits: pa.Table, vectors: DataFrame, tie: str, digits: int | None) -> DataFrame:
    """query_id, place, ahead: how many vectors come before each hit (query_id, place, score, tie), from one pass over the vectors; a row a hit a task."""
    block = collected(queries)
    at = {x: i for i, x in enumerate(block.ids.to_pylist())}
    own: list[list[tuple]] = [[] for _ in at]
    for query_id, place, score, key in zip(*(hits.column(c).to_pylist() for c in ("query_id", "place", "score", tie)), strict=True):
        own[at[query_id]].append((score, place, key))
    own = [sorted(x, key=lambda h: (h[0], -h[1])) for x in own]  # from the lowest score up, of equal ones the last place first
    bounds = [np.array([h[0] for h in x]) for x in own]
    lowest = np.array([x[0] if len(x) else np.inf for x in bounds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(x) + 1, np.int64) for x in own]
        exact = [np.zeros(len(x), np.int64) for x in own]
        for b in batches:
            for rows, vectors in parts(b, block.dims, len(block)):
                scores, wide = block.vectors @ vectors.T, margin(block, vectors, digits)
                some = scores >= (lowest - wide)[:, None]  # what may be ahead of any hit, which few are
                for i in np.flatnonzero(some.any(axis=1)).tolist():
                    mine, part = own[i], np.flatnonzero(some[i])
                    column = scores[i][part]
                    over = np.searchsorted(bounds[i] + wide[i], column, side="left")  # hits that are surely behind
                    counts[i] += np.bincount(over, minlength=len(mine) + 1)
                    near = np.flatnonzero(np.searchsorted(bounds[i] - wide[i], column, side="right") != over)
                    if len(near):
                        again = in_order(vectors[part[near]], np.broadcast_to(block.vectors[i], (len(near), block.dims)), digits)
                        keys = b.column(tie).take(pa.array(rows[part[near]])).to_pylist()
                        for s, key, j in zip(again.tolist(), keys, over[near].tolist(), strict=True):
                            for h in range(j, len(mine)):
                                exact[i][h] += s > mine[h][0] or (s == mine[h][0] and before(key, mine[h][2]))
        ids, places, n = [], [], []
        for i, mine in enumerate(own):
            surely = np.cumsum(counts[i][::-1])[::-1][1:]
            for (_, place, _), c, e in zip(mine, surely.tolist(), exact[i].tolist(), strict=True):
                ids.append(i)
                places.append(place)
                n.append(c + e)
        yield pa.RecordBatch.from_arrays([block.ids.take(pa.array(ids, pa.int64())), pa.array(places, pa.int32()), pa.array(n, pa.int64())], ["query_id", "place", "ahead"])

    kind = queries.schema["query_id"].dataType.simpleString()
    return vectors.select("embedding", tie).mapInArrow(run, f"query_id {kind}, place int, ahead long")


def before(a, b) -> bool:
    """Whether a key comes before another in ascending order, nulls first; a struct's fields in order."""
    if isinstance(a, dict) and isinstance(b, dict):
        for x, y in zip(a.values(), b.values(), strict=True):
            if x != y:
                return before(x, y)
        return False
    if a is None or b is None:
        return a is None and b is not None
    return a < b
