"""The clients against a server of our own, and operators of files that the queries use with stand-ins only."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from factloom import fixed_values as V
from factloom import stand_ins
from factloom.operators import checks, extraction, external, retrieval, vectors
from factloom.sources import files


class Handler(BaseHTTPRequestHandler):
    def log_message(self, *args):
        pass

    def do_GET(self):
        code = 404 if "missing" in self.path else 200
        body = b"<html>" + "é".encode("latin-1") * 900 + b"</html>" if "page" in self.path else b"short"
        self.send_response(code)
        self.send_header("Content-Type", "text/html; charset=latin-1")
        self.end_headers()
        self.wfile.write(body)

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        reply = {"a": {"response": " x "}, "b": {"response": "", "thinking": "t"}, "c": {"message": {"content": "m"}}, "d": {"message": "no"}}.get(asked["prompt"])
        self.send_response(200 if reply else 500)
        self.end_headers()
        self.wfile.write(json.dumps(reply or {"error": asked["format"]}).encode())


@pytest.fixture(scope="module")
def server():
    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_http_fetcher(server):
    get = external.HttpFetcher(timeout=5)
    assert external.page_once(f"{server}/page", get) == "<html>" + "é" * 900 + "</html>"
    assert external.page_once(f"{server}/short", get) is None and external.page_once(f"{server}/page/missing", get) is None
    assert external.page_once("http://127.0.0.1:9/none", get) is None
    assert external.fetch_once(f"{server}/missing", get, wait=stand_ins.no_wait)[:2] == (False, "http_404")
    assert external.fetch_once(f"{server}/x", get)[1].startswith("non_pdf_content_type:text/html")


def test_model_server(server):
    ask = external.ModelServer(server, "m", timeout=5)
    assert [ask(p) for p in "abcd"] == ["x", "t", "m", ""]
    with pytest.raises(RuntimeError, match="500"):
        ask("e")


def test_prompts_name_what_they_ask():
    for text in (extraction.strict_prompt("q?", "ctx", 2024), extraction.loose_nii_prompt("ctx", 2024), extraction.one_metric_prompt("ROE", "ctx", 2024), extraction.many_metrics_prompt("q?", "ctx", 2024)):
        assert "ctx" in text and "2024" in text and "NOT FOUND" in text
    assert all(m in extraction.strict_prompt("q?", "ctx", 2024) for m in V.METRICS)


def test_answers_in_prose():
    assert extraction.parsed_answer('see {not json} but {"value": "1", "unit": "%"} ok', 2024) == {"value": "1", "unit": "%"}
    assert extraction.parsed_answer("value: 1,250 unit: thousand; [k=a|stem=b|chunk=4]", 2024)["value"] == "1250"


def test_missing_pdf_reader_is_a_row(spark):
    made = spark.createDataFrame([("a.pdf", bytearray(b"no pdf"))], "path string, content binary")
    r = external.paged(made).first()
    assert (r.path, r.page) == ("a.pdf", -1) and r.error


def test_paths_and_limits(spark):
    assert [files.resolved("/r/", p) for p in ("a/b", "/a", "s3://x/y")] == ["/r/a/b", "/a", "s3://x/y"]
    rows = spark.range(10).select(F.col("id"))
    assert files.limited(rows, 3, [F.desc("id")]).count() == 3 and files.limited(rows, None, ["id"]).count() == 10


def test_validator_prefers_the_first_pattern_and_short_paths(spark):
    rows = [("/x/links.csv", 1), ("/x/long/entry_pages.csv", 0), ("/y/entry_pages.csv", 5), ("/y/metrics_2024.csv", 0), ("/y/kpi_2024.csv", 9)]
    got = {r.stage: (r.n_files, r.path, r.status) for r in checks.validated(spark.createDataFrame(rows, "path string, size long"), 2024).collect()}
    assert got["entry_pages"] == (3, "/y/entry_pages.csv", "ok") and got["metrics"] == (2, "/y/metrics_2024.csv", "empty") and got["reports"] == (0, None, "missing")


def test_older_key_of_hits(spark):
    rows = [("b", "m", 0, 1, "b", s, c, "t", score) for s, c, score in (("x", 0, 0.9), ("x", 1, 0.8), ("y", 1, 0.7))]
    hits = spark.createDataFrame(rows, "target string, metric string, place int, rank int, bank string, stem string, chunk_id int, text string, score double")
    wide = spark.createDataFrame([("m", 9, 9, 9, 0.1)], "metric string, asked int, kept int, shown int, least double")
    own = lambda flag: {(r.stem, r.chunk_id) for r in retrieval.per_metric(hits, hits.select("bank", "stem", "chunk_id", "text").where("false"), wide, flag).collect()}
    assert own(False) == {("x", 0), ("x", 1), ("y", 1)} and own(True) == {("x", 1)}


def test_depth_by_blocks(spark, monkeypatch):
    v = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    q = v.where("vec_id < 60").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    found = lambda: sorted(tuple(r) for r in vectors.adaptive_top_k(q, v, F.col("label") == 3, 5, 20, 1000, "vec_id", 9).select("query_id", "vec_id", "rank").collect())
    once = found()
    monkeypatch.setattr(vectors, "BROADCAST_QUERIES", 25)
    assert found() == once and once
