"""Which of many keywords stand in a text: one automaton over all of them, all texts of an Arrow batch stepped together.

The automaton is a trie of the keywords' bytes with failure links (where the longest suffix that is a prefix of a keyword
leads) and report links (the next shorter keyword that ends at the same place), so overlapping keywords are all found in
one reading. It is built once in each worker process for each table of rules.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import bounded
from .vectors import blocks

#: Rules of one automaton; more are taken in blocks of this size.
RULES_AT_ONCE = 200_000


class Automaton:
    def __init__(self, words: list[bytes]):
        """Words may repeat; an empty one stands in every text."""
        self.always = np.array([i for i, w in enumerate(words) if not w], np.int64)
        child: list[dict[int, int]] = [{}]
        ends: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            v = 0
            for c in w:
                nxt = child[v].get(c)
                if nxt is None:
                    nxt = child[v][c] = len(child)
                    child.append({})
                v = nxt
            if w:
                ends.setdefault(v, []).append(i)
        n = len(child)
        fail, report, order = np.zeros(n, np.int64), np.zeros(n, np.int64), [0]
        for v in order:
            for c, w in child[v].items():
                order.append(w)
                u = int(fail[v])
                while u and c not in child[u]:
                    u = int(fail[u])
                fail[w] = child[u][c] if v and c in child[u] else 0
                report[w] = fail[w] if int(fail[w]) in ends else report[fail[w]]
        self.fail, self.report = fail, report
        keys = np.array([v << 8 | c for v in range(n) for c in child[v]], np.int64)
        to = np.array([w for v in range(n) for w in child[v].values()], np.int64)
        by = np.argsort(keys)
        self.keys, self.to = np.append(keys[by], np.iinfo(np.int64).max), np.append(to[by], 0)
        self.first = np.zeros(256, np.int64)
        for c, w in child[0].items():
            self.first[c] = w
        counts = np.zeros(n + 1, np.int64)
        for v, found in ends.items():
            counts[v + 1] = len(found)
        self.at = np.cumsum(counts)
        self.words = np.array([i for v in range(n) for i in ends.get(v, ())], np.int64)

    def step(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(states), np.int64), np.arange(len(states))
        now = states
        while len(open_):
            root = now == 0
            out[open_[root]] = self.first[chars[open_[root]]]
            open_, now = open_[~root], now[~root]
            key = now << 8 | chars[open_]
            at = np.searchsorted(self.keys, key)
            there = self.keys[at] == key
            out[open_[there]] = self.to[at[there]]
            open_, now = open_[~there], self.fail[now[~there]]
        return out

    def found(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, word) pairs, each once, in order of text and word."""
        size = np.array([len(t) for t in texts], np.int64)
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        states, hits = np.zeros(len(texts), np.int64), []
        live, k = np.flatnonzero(size), 0
        while len(live):
            states[live] = now = self.step(states[live], data[start[live] + k])
            at = now
            who = live
            while len(who):  # the keyword that ends here and all shorter ones
                some = self.at[at + 1] > self.at[at]
                hits.append(np.stack((who[some], at[some])))
                some = self.report[at] > 0
                who, at = who[some], self.report[at[some]]
            k += 1
            live = live[size[live] > k]
        text, node = np.concatenate(hits, axis=1) if hits else np.zeros((2, 0), np.int64)
        n = self.at[node + 1] - self.at[node]
        pick = np.repeat(self.at[node] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        text, word = np.repeat(text, n), self.words[pick]
        text = np.concatenate((text, np.repeat(np.arange(len(texts)), len(self.always))))
        word = np.concatenate((word, np.tile(self.always, len(texts))))
        pairs = np.unique(np.stack((text, word)), axis=1)
        return pairs[0], pairs[1]


_made: dict[str, Automaton] = {}
HIT = "array<struct<place:int,tag:string,keyword:string,points:int>>"


def _matcher(spark: SparkSession, rules: list[tuple]):
    """A function from arrays of lower-case texts to the hits of each row."""
    rules = sorted(rules)
    lower = [r[0] for r in spark.createDataFrame([(i, r[2]) for i, r in enumerate(rules)], "i int, k string").orderBy("i").select(F.lower("k")).collect()] if rules else []
    shared, name = spark.sparkContext.broadcast((rules, lower)), uuid.uuid4().hex
    kind = pa.list_(pa.struct([("place", pa.int32()), ("tag", pa.string()), ("keyword", pa.string()), ("points", pa.int32())]))

    def hits(*columns: pa.Array) -> pa.Array:
        rules, lower = shared.value
        if name not in _made:
            while len(_made) > 3:
                _made.pop(next(iter(_made)))
            _made[name] = Automaton([(k if k is not None else "\ud800").encode("utf-8", "surrogatepass") for k in lower])
        machine, n = _made[name], len(columns[0])
        # a text that is not there has no hits, not even of the empty keyword
        texts = [(i, t.encode()) for c in columns for i, t in enumerate(c.to_pylist()) if t is not None]
        of, word = machine.found([t for _, t in texts])
        row = np.array([i for i, _ in texts], np.int64)[of]
        row, word = np.unique(np.stack((row, word)), axis=1) if len(row) else (row, word)
        at = np.searchsorted(row, np.arange(n + 1))
        place, tag, keyword, points = zip(*rules, strict=True) if rules else ((), (), (), ())
        taken = [pa.array(c, t).take(pa.array(word)) for c, t in ((place, pa.int32()), (tag, pa.string()), (keyword, pa.string()), (points, pa.int32()))]
        values = pa.StructArray.from_arrays(taken, fields=list(kind.value_type))
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)

    return hits


def matched(spark: SparkSession, rules: list[tuple], *texts: Column) -> Column:
    """The rules (place, tag, keyword, points) whose keyword stands in one of the texts, without regard to case, in rule order; none for a null text."""
    found = _matcher(spark, rules)

    @F.arrow_udf(HIT)
    def hits(*columns: pa.Array) -> pa.Array:
        return found(*columns)

    return hits(*(F.lower(t) for t in texts))


def matched_rules(rows: DataFrame, rules: DataFrame, key: str, *texts: Column) -> DataFrame:
    """key, hits: the rows with at least one hit of a table of rules of any size. Rules are read in blocks, each one pass over the texts; blocks of one row come together again by its key."""
    lower = bounded(rows).select(key, *(F.lower(t).alias(f"_{i}") for i, t in enumerate(texts)))
    out = None
    for part in blocks(rules.where("keyword IS NOT NULL"), "place", RULES_AT_ONCE):
        find = _matcher(rows.sparkSession, [tuple(r) for r in part.select("place", "tag", "keyword", "points").collect()])

        def run(batches: Iterator[pa.RecordBatch], find=find) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hits = find(*b.columns[1:])
                some = pc.greater(pc.list_value_length(hits), 0)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(some), hits.filter(some)], [key, "hits"])

        # read by one pass: a filter on a column that Python makes has it made twice
        own = lower.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, hits {HIT}")
        out = own if out is None else out.unionByName(own)
    return out
