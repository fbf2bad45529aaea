"""Sharding along a Hilbert curve.

Language, source and text size are quantised to a few bits each, by equal depth: a
value's coordinate is the share of rows before it in the order of values, so frequent
values have coordinates of their own and neighbours in the alphabet are neighbours.
The cell's index on the three-dimensional Hilbert curve orders the rows; the order is
cut into runs of equal row counts. Neighbouring cells lie in the same shard, so that a
reader with predicates on several of the dimensions skips whole shards and row groups.

Equal texts are a group: they take the cell of the least of them and go to one shard.
Large groups (more than 1 / GROUP_SHARE of a shard's rows, so their number is bounded)
come first, the largest first: each goes whole to the shard with room for it that is
nearest to its place on the curve. Only a group that no shard has room for is cut, as
rows like others. Other groups go to the shard in which they begin; the other rows fill
the shards up in their order, so the counts differ by one at most. Where groups alone
would overfill a shard, all but the large ones are cut along the order, so that one
group at each cut is split, which the law asks for.

The rows themselves never pass a single task: counts of (cell, salt) buckets give
each bucket its place in the order, and a row's rank is that place plus its number
in its own bucket. The number of salts follows the rows.

Defined results: a null text has size 1 and CRC 0 and is equal to an empty one; null
language or source is a value of its own, before the others; rows that are equal
throughout get different slots; an empty table gives no rows; further columns of the
input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

BITS = 5
DIMS = 3
#: Rows of a bucket, about, if a single cell had all rows.
BUCKET_ROWS = 50_000
LEAST_SALTS = 16
GROUP_SHARE = 16
#: Ranges in which the distinct values of a dimension are ranked.
VALUE_RANGES = 16


def hilbert_index(coordinates: list[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points; each coordinate has `bits` bits. Works axis by axis on whole arrays."""
    x = [np.asarray(c, dtype=np.int64).copy() for c in coordinates]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess rotations from the high bit down
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> b) & 1, (1 << b) - 1, 0)
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ turn) >> b) & 1)
    return out


def by_depth(rows: DataFrame, column: str, total: int, bits: int) -> DataFrame:
    """column and coordinate of each distinct value: how many of 2**bits equal parts of the rows lie before it. Ranges of values are counted apart."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    parts = written(counts.repartitionByRange(VALUE_RANGES, F.col(column).asc_nulls_first()).withColumn("part", F.spark_partition_id()), "values")
    sizes = {r.part: r.n for r in parts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, starts = 0, {}
    for part in sorted(sizes):
        starts[part], before = before, before + sizes[part]
    start = F.create_map(*(F.lit(x) for pair in (starts or {0: 0}).items() for x in pair))[F.col("part")]
    upto = Window.partitionBy("part").orderBy(F.col(column).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = F.expr(f"least({(1 << bits) - 1}, (place * {1 << bits}L) div {max(1, total)})").cast("int")
    return parts.withColumn("place", start + F.sum("n").over(upto) - F.col("n")).select(F.col(column).alias("value"), cut.alias("coordinate"))


def quantised(rows: DataFrame, total: int, bits: int = BITS) -> DataFrame:
    """The rows with their coordinates q0 (language), q1 (source) and q2 (size)."""
    for k, column in enumerate(("lang", "source")):
        values = by_depth(rows, column, total, bits)
        rows = rows.join(values, F.col(column).eqNullSafe(F.col("value")), "left").withColumn(f"q{k}", F.col("coordinate")).drop("value", "coordinate")
    steps = 1 << bits
    cuts = rows.agg(F.percentile_approx("size", [k / steps for k in range(1, steps)], 10_000)).first()[0] or []
    above = [F.when(F.col("size") > F.lit(c), 1).otherwise(0) for c in cuts]
    return rows.withColumn("q2", sum(above, F.lit(0)).cast("int"))


def shard(docs: DataFrame, n_shards: int = 8, bits: int = BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law `rows`, shard, slot, grown_shard (null), then the coordinates and the curve index of each row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64(F.lit(1), text).alias("h1"), F.xxhash64(F.lit(2), text).alias("h2"),
    )
    rows = written(rows, "rows")
    total = rows.count()
    cell = [f"q{i}" for i in range(DIMS)]
    quota = [-(-(k + 1) * total // n_shards) - -(-k * total // n_shards) for k in range(n_shards)]
    first = rows
    rows = quantised(rows, total, bits).drop("lang", "source")
    groups = written(rows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct(*cell)).alias("cell")).where("n > 1"), "groups")
    most = max(1, total // n_shards // GROUP_SHARE)
    placed, room = _large(rows, groups.where(F.col("n") > most), quota, cell, bits)
    large = None
    if placed:
        own = F.broadcast(docs.sparkSession.createDataFrame(placed, "h1 long, h2 long, shard int, base long, a0 int, a1 int, a2 int"))
        large = _whole(rows.join(own, ["h1", "h2"]), max(LEAST_SALTS, -(-total // bucket_rows)), cell, bits)
        rows = rows.join(own.select("h1", "h2"), ["h1", "h2"], "left_anti")
        groups = groups.join(own.select("h1", "h2"), ["h1", "h2"], "left_anti")
    total = sum(room)
    # a group that is too large for any shard is cut like other rows
    groups = groups.where(F.col("n") <= most)
    rows = rows.join(groups.select("h1", "h2", "cell"), ["h1", "h2"], "left")
    grouped = F.col("cell").isNotNull()
    salts = max(LEAST_SALTS, -(-total // bucket_rows))
    salt = F.pmod(F.when(grouped, F.xxhash64("h1")).otherwise(F.xxhash64("doc_id", "h1")), F.lit(salts)).cast("int")
    rows = rows.select("doc_id", "size", "text_crc32", "h1", "h2", *(F.coalesce(F.col("cell")[c], F.col(c)).alias(f"at{i}") for i, c in enumerate(cell)), *cell, grouped.alias("grouped"), salt.alias("salt"))
    rows = written(rows, "cells")
    discard(first)
    at = [f"at{i}" for i in range(DIMS)]

    @F.pandas_udf("long")
    def index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([a.to_numpy(), b.to_numpy(), c.to_numpy()], bits))

    counts = rows.groupBy(*at, "salt").agg(F.count_if(~F.col("grouped")).alias("singles"), F.count_if("grouped").alias("members"))
    cells = counts.groupBy(*at).agg(F.sum("singles").alias("cell_singles"), F.sum("members").alias("cell_members")).withColumn("hilbert", index(*at))
    curve = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(*at).orderBy("salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = lambda c, w: F.sum(c).over(w) - F.col(c)
    cells = cells.select(*at, "hilbert", upto("cell_singles", curve).alias("cs"), upto("cell_members", curve).alias("cm"))
    places = counts.withColumn("s", upto("singles", inside)).withColumn("m", upto("members", inside)).join(cells, at)
    places = places.select(*at, "salt", "hilbert", "singles", (F.col("s") + F.col("cs")).alias("s"), (F.col("m") + F.col("cm")).alias("m"))
    # in a bucket the single rows come first, then the groups
    own = Window.partitionBy(*at, "salt", "grouped").orderBy("h1", "h2", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("own", F.row_number().over(own) - 1)
    ranked = ranked.withColumn("first", F.when(F.col("grouped"), F.min("own").over(Window.partitionBy(*at, "salt", "grouped", "h1", "h2"))))
    ranked = ranked.join(places, [*at, "salt"]).select(
        "doc_id", "size", "text_crc32", "grouped", *cell, "hilbert",
        # singles and members that come before the row, and before its group
        (F.col("s") + F.when(F.col("grouped"), F.col("singles")).otherwise(F.col("own"))).alias("s"), (F.col("m") + F.when(F.col("grouped"), F.col("own")).otherwise(0)).alias("m"), (F.col("m") + F.col("first")).alias("first"),
    )
    ranked = written(ranked.withColumn("begins", _place(F.col("s") + F.col("first"), [sum(room[:k]) for k in range(n_shards)])), "ranks")
    discard(rows)
    others = _cut(ranked, room, cell)
    return others if large is None else others.unionByName(large)


def _large(rows: DataFrame, groups: DataFrame, quota: list[int], cell: list[str], bits: int) -> tuple[list[tuple], list[int]]:
    """(h1, h2, shard, first slot, cell) of each large group that a shard has room for, and the rows that are left to each shard. The groups and the cells are few by their bounds."""
    found = sorted(groups.collect(), key=lambda g: (-g.n, g.h1, g.h2))
    room = list(quota)
    if not found:
        return [], room
    cells = [(tuple(r[c] for c in cell), r.n) for r in rows.groupBy(*cell).agg(F.count("*").alias("n")).collect()]
    at = hilbert_index(list(np.array([c for c, _ in cells]).T), bits)
    before, wanted = 0, {}
    for i in np.argsort(at, kind="stable").tolist():
        wanted[cells[i][0]] = before
        before += cells[i][1]
    starts, out = np.cumsum([0, *quota])[:-1], []
    for g in found:
        here = int(np.searchsorted(starts, wanted[tuple(g.cell)], side="right")) - 1
        fits = [k for k in range(len(room)) if room[k] >= g.n]
        if fits:
            k = min(fits, key=lambda k: (abs(k - here), k))
            room[k] -= g.n
            out.append((g.h1, g.h2, k, room[k], *g.cell))
    return out, room


def _whole(rows: DataFrame, salts: int, cell: list[str], bits: int) -> DataFrame:
    """The rows of large groups with their slots, from the first one of their group on: a group is numbered in salted parts."""
    salt = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    rows = written(rows.withColumn("salt", salt), "large")
    upto = Window.partitionBy("h1", "h2").orderBy("salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = rows.groupBy("h1", "h2", "salt").agg(F.count("*").alias("n")).withColumn("earlier", F.sum("n").over(upto) - F.col("n"))
    own = F.row_number().over(Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "size")) - 1

    @F.pandas_udf("long")
    def index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([a.to_numpy(), b.to_numpy(), c.to_numpy()], bits))

    ranked = rows.withColumn("own", own).join(counts.drop("n"), ["h1", "h2", "salt"]).withColumn("slot", (F.col("base") + F.col("earlier") + F.col("own")).cast("long"))
    return ranked.withColumn("hilbert", index("a0", "a1", "a2")).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert", *cell)


def _cut(ranked: DataFrame, quota: list[int], cell: list[str]) -> DataFrame:
    """The shards, with so many rows each: a few numbers of each shard decide."""
    n_shards = len(quota)
    held = {r.begins: r.n for r in ranked.where("grouped").groupBy("begins").agg(F.count("*").alias("n")).collect()}
    members = [held.get(k, 0) for k in range(n_shards)]
    out = ["doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert", *cell]
    if any(m > q for m, q in zip(members, quota, strict=True)):
        starts = [sum(quota[:k]) for k in range(n_shards)]
        rank = F.col("s") + F.col("m")
        shard = _place(rank, starts)
        return ranked.withColumn("shard", shard).withColumn("slot", rank - _number("shard", starts)).select(*out)
    singles = [q - m for q, m in zip(quota, members, strict=True)]
    s_starts, m_starts = ([sum(x[:k]) for k in range(n_shards)] for x in (singles, members))
    rows = ranked.withColumn("shard", F.when(F.col("grouped"), F.col("begins")).otherwise(_place(F.col("s"), s_starts)))
    # a row's slot: how many of either kind its shard has before it
    before = lambda c, starts, size: F.greatest(F.lit(0), F.least(F.col(c) - _number("shard", starts), _number("shard", size)))
    return rows.withColumn("slot", before("s", s_starts, singles) + before("m", m_starts, members)).select(*out)


def _place(rank: Column, starts: list[int]) -> Column:
    """The last part that starts at or before the rank and isn't empty."""
    return (sum((F.when(rank >= F.lit(x), 1).otherwise(0) for x in starts), F.lit(0)) - 1).cast("int")


def _number(part: str, numbers: list[int]) -> Column:
    return F.element_at(F.array(*(F.lit(x).cast("long") for x in numbers)), F.col(part) + 1)


def manifest(sharded: DataFrame) -> DataFrame:
    """Per shard the row count and the range of each coordinate and of the index: what a reader prunes files by."""
    what = ["hilbert", *(f"q{i}" for i in range(DIMS))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *(f(c).alias(f"{k}_{c}") for c in what for k, f in (("min", F.min), ("max", F.max))))


def write_shards(docs: DataFrame, sharded: DataFrame, path: str) -> None:
    """The documents as Parquet, a folder per shard, in slot order within a file, so that row groups have narrow ranges."""
    place = sharded.select("doc_id", "shard", "slot", "hilbert")
    out = docs.join(place, "doc_id")
    parts = max(1, int(out.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    out.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
