"""Model answers read by built-in functions against the reader in Python, and what calls are made."""

import json

import pytest
from pyspark.sql import functions as F

from factloom import fixed_values as V
from factloom.operators import extraction as X

M = V.METRICS
ROW = {"metric_name": M[0], "value": "1.5", "unit": "%", "fiscal_year": 2024, "source_chunk_id": "[k=a|chunk=1]"}
ANSWERS = [
    json.dumps({"results": [ROW]}), json.dumps({"results": [ROW, {**ROW, "value": "2"}, {"metric_name": M[1], "value": "9"}]}), json.dumps({"results": [{**ROW, "value": ""}, {"x": 1}, 5, None]}),
    json.dumps({"results": [{**ROW, "value": None, "unit": None}]}), json.dumps({"results": [{"metric_name": M[1], "value": "3"}]}), json.dumps({"results": [{"metric_name": M[0]}]}), json.dumps({"results": []}),
    json.dumps({"results": "none", "value": "1", "source_chunk_id": "2"}), json.dumps({"value": "8.5", "unit": "%", "source_chunk_id": "12"}), json.dumps({"value": "8.5"}), json.dumps({"value": None, "source_chunk_id": None}),
    json.dumps({"results": [{**ROW, "value": 1.50}]}), json.dumps({"value": 10**30, "source_chunk_id": 7, "unit": True}), json.dumps({"results": [{**ROW, "value": [1, {"a": None}]}]}), json.dumps({next(iter(V.METRIC_SYNONYMS)): "0.75%"}),
    "Sure: " + json.dumps({"results": [ROW]}) + " ok", '{"value": "1", "value": "2", "source_chunk_id": "x"}', "[1, 2]", '"text"', "NaN", "null", "", "   ", "value: 1,250 unit: thousand; [k=a|stem=b|chunk=4]", '{"results": [', "é {x} {}",
    "  " + json.dumps({"results": [{**ROW, "unit": "é\n\"q\""}]}, ensure_ascii=False) + "\n", json.dumps({"results": [{**ROW, "metric_name": 5}]}), json.dumps({"results": [{**ROW, "metric_name": "other"}]}), json.dumps({"results": {"metric_name": M[0], "value": "1"}}),
]


def plain(raw, metric):
    obj = X.parsed_answer(raw, 2024)
    formed = X.is_results(obj) or (isinstance(obj, dict) and "value" in obj)
    return X.normalised(obj, metric).get(metric, (X.MISSING,) * 3), formed


def test_what_is_read_is_right(spark):
    rows = [(str(i), m, raw) for i, raw in enumerate([*ANSWERS, None]) for m in (M[0], M[1], "unknown")]
    got = X.read_answers(spark.createDataFrame(rows, "target string, metric string, raw string"))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString() and "Arrow" not in got._jdf.queryExecution().executedPlan().toString()
    read = [r for r in got.collect() if r.is_read]
    for r in read:
        assert ((r.value, r.unit, r.source_chunk_id), True) == plain(r.raw, r.metric), r
    # all answers of a known form with strings are read there
    well = {0, 1, 2, 3, 4, 8, 10, 26}
    assert {int(r.target) for r in read if r.metric == M[0]} >= well
    assert not {int(r.target) for r in read if r.metric == M[0]} & {11, 12, 13, 15, 17, 21, 23, 24}


@pytest.mark.parametrize("fails", [False, True])
def test_answers(spark, tmp_path, fails):
    """The same rows as one answer after the other gives, each prompt asked once."""
    log = tmp_path / "calls"

    def model(prompt):
        with open(log, "a") as f:
            f.write(json.dumps(prompt) + "\n")
        if prompt.startswith("Turn this"):
            if fails:
                raise TimeoutError("second")
            return json.dumps({"results": [{**ROW, "value": "mended"}]})
        k = int(prompt.rsplit("no ", 1)[1])
        if k == len(ANSWERS):
            raise ValueError("first")
        return ANSWERS[k]

    rows = [(f"t{i}", M[0], f"context no {i}") for i in range(len(ANSWERS) + 1)]
    evidence = spark.createDataFrame(rows, "target string, metric string, context string").repartition(3)
    got = {r.target: tuple(r)[1:] for r in X.asked_of_model(evidence, model, 2024).collect()}
    want = {}
    for i, raw in enumerate(ANSWERS):
        value, formed = plain(raw, M[0])
        if not formed:
            value = (X.MISSING,) * 3 if fails else ("mended", "%", ROW["source_chunk_id"])
        want[f"t{i}"] = (M[0], *value, "model", "TimeoutError: second" if fails and not formed else None)
    want[f"t{len(ANSWERS)}"] = (M[0], *(X.MISSING,) * 3, "model", "ValueError: first")
    assert got == want
    calls = [json.loads(x) for x in open(log)]
    assert len(calls) == len(set(calls)) == len(rows) + sum(not plain(raw, M[0])[1] for raw in set(ANSWERS))


def test_nothing_asked(spark):
    none = spark.createDataFrame([], "target string, metric string, context string")
    assert X.asked_of_model(none, lambda p: "", 2024).select(F.col("target")).collect() == []
