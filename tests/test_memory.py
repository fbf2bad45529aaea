"""What Python holds at a time doesn't grow with the tables."""

from factloom.operators import chunks, pages
from factloom.sources import files

ROWS = "arrow.maxRecordsPerBatch"


def test_texts_come_in_small_batches(spark):
    docs = spark.createDataFrame([(1, "x" * 3000)], "doc_id long, text string")
    for made in (chunks.covered(docs, ["doc_id"]), chunks.chunked(docs, ["doc_id"])):
        assert int(made.sparkSession.conf.get(f"spark.sql.execution.{ROWS}")) <= 1000 < int(spark.conf.get(f"spark.sql.execution.{ROWS}"))
        assert made.count() == 3


def test_rules_read_pages_once_and_in_small_batches(spark):
    rules = spark.createDataFrame([(1, "T", "annual", 2), (2, "NEG", "zz", -1)], "place int, tag string, keyword string, points int")
    table = spark.createDataFrame([(1, "http://h/ANNUAL", "<title>zz</title>"), (2, "http://h", ""), (None, "http://h/zz", None)], "page_id long, url string, html string")
    out = pages.score_by_rules(table, rules)
    assert sorted(((r.page_id, r.score, r.reasons) for r in out.collect()), key=str) == [(1, 1, "T::annual;NEG::zz"), (None, -1, "NEG::zz")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert int(out.sparkSession.conf.get(f"spark.sql.execution.{ROWS}")) <= 1000


def test_files_are_listed_in_tasks(spark, tmp_path):
    names = ["a/x.pdf", "a/y.txt", "a/_no.pdf", "b/é z.pdf", ".c/x.pdf", "loose.pdf", "a/deep/x.pdf"]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(n.encode())
    for root in (str(tmp_path), tmp_path.as_uri()):
        found = files.read_pdfs(spark, root)
        assert "binaryFile" not in found._jdf.queryExecution().optimizedPlan().toString() and found.inputFiles() == []
        assert sorted((r.bank_folder, r.length, bytes(r.content).decode()) for r in found.collect()) == [("a", 7, "a/x.pdf"), ("b", 10, "b/é z.pdf")]
        assert "ArrowEvalPython" not in found.drop("content")._jdf.queryExecution().optimizedPlan().toString()
