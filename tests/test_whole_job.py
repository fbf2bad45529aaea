"""Registered queries do the whole job: no text, target or row is left out."""

from factloom import fixed_values as V
from factloom.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_no_text_between_windows(spark, tmp_path):
    sizes = {1: 0, 2: 10, 3: 20_000, 4: 130_000, 5: 300_001, 6: 1_799_999}
    spark.createDataFrame([(k, "x" * n) for k, n in sizes.items()], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    reach = dict.fromkeys(sizes, 0)
    for r in QUERIES["full_coverage_production"](spark, str(tmp_path)).orderBy("doc_id", "chunk_id").collect():
        assert r.char_start <= reach[r.doc_id]
        reach[r.doc_id] = max(reach[r.doc_id], r.char_end)
    assert reach == sizes


def test_plan_for_every_source(spark):
    got = QUERIES["extraction_plan_all"](spark, SF).collect()
    sources = {r.source for r in spark.read.parquet(f"{SF}/documents.parquet").select("source").distinct().collect()} - {None}
    assert len(sources) > 3 and {(r.bank, r.metric_name) for r in got} == {(s, m) for s in sources for m in V.METRICS} and len(got) == len(sources) * len(V.METRICS)
    # what the plan says about a source does not hang on which others are asked for
    few = {tuple(r) for r in QUERIES["extraction_plan"](spark, SF).collect() if r.bank != "nobody"}
    assert few == {tuple(r) for r in got if r.bank in ("src1", "src2")}
