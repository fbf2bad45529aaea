"""The quality model on labelled documents that it was not fitted on."""

from pyspark.sql import functions as F

from factloom.llm import quality_crf
from factloom.llm.common import bounded


def test_documents_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = bounded(spark.read.parquet(f"{sf}/documents.parquet")), spark.read.parquet(f"{sf}/labels.parquet")
    odd = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    weights, stay = quality_crf.fit(docs, labels.where(odd))
    judged = quality_crf.judge(docs, weights, stay).select("doc_id", "kept", "base_failed")
    rows = labels.where(~odd).join(judged.where("NOT base_failed"), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    good, bad = n.get((1, True), 0) + n.get((1, False), 0), n.get((0, True), 0) + n.get((0, False), 0)
    assert good > 100 and bad > 5
    assert n.get((1, True), 0) >= 0.97 * good and n.get((0, False), 0) >= 0.9 * bad
