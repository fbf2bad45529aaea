"""Literal cases of the operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom import fixed_values as V
from factloom.functions import text as T
from factloom.functions import urls as U
from factloom.operators import checks, chunks, crawl, downloads, external, extraction, metrics, pages, retrieval, vectors
from factloom.plans import extract as plans
from factloom.sources import files, matrices
from factloom.streaming import ingest


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_text_functions(spark):
    lit = F.lit
    r = one(spark, T.clean_text(lit("a \t b\r\n\n\n\nc")), T.slug(lit("report.pdf")), U.file_name(lit("http://x/report.pdf?y")), T.human_size(lit(1280)), T.money(lit("(1,234)")), T.money(lit("2,/75")), T.guessed_unit(lit("($ in thousands)")), T.guessed_unit(lit("$5")), T.guessed_unit(lit("5")), T.slug(lit(" .. ")))
    assert tuple(r) == ("a b\n\nc", "reportpdf", "reportpdf.pdf", "1.2KB", -1234.0, None, "thousand", "dollars", "NOT FOUND", "unknown")
    v, u = T.value_and_unit(lit("8.69 %"), lit(None).cast("string"))
    assert tuple(one(spark, v, u)) == ("8.69", "%")
    cites = [T.is_valid_citation(lit(c)) for c in ("[k=a|stem=b|chunk=3]", "12", "abc")]
    assert tuple(one(spark, *cites)) == (True, True, False)
    assert tuple(one(spark, T.stem_of(lit("[k=a|stem=AR 2023|chunk=1]")), F.array_join(T.years(lit("2018 and 2024")), ","))) == ("AR 2023", "2018,2024")
    levels = [pages.level(lit(s)) for s in (30, 29, 15, 5, 4)]
    assert tuple(one(spark, *levels)) == ("HIGH", "MEDIUM", "MEDIUM", "LOW", None)


def test_urls(spark):
    lit = F.lit
    cases = {"https://a.b.example.co.uk/x": "co.uk", "www.x.com/p": "x.com", "": None, "http://localhost:80/": "localhost:80"}
    assert list(one(spark, *[U.root_host(lit(u)) for u in cases])) == list(cases.values())
    hrefs = {"/r": "http://h/r", "x": "http://h/d/x", "//o/y": "http://o/y", "#f": "http://h/d/p?q#f", "?z": "http://h/d/p?z", "https://k/": "https://k/", "": "http://h/d/p?q"}
    assert list(one(spark, *[U.joined(lit("http://h/d/p?q"), lit(h)) for h in hrefs])) == list(hrefs.values())
    assert one(spark, U.pdf_score(lit("http://h/x.pdf"), lit("Annual Report 2024")))[0] == 34


def test_chunks(spark):
    df = spark.createDataFrame([("a", "x" * 1400), ("b", "y" * 49), ("c", "z" * 50)], "k string, text string")
    got = chunks.chunked(df, ["k"]).orderBy("k", "chunk_id").select("k", "char_start", "char_end").collect()
    assert [tuple(r) for r in got] == [("a", 0, 1400), ("a", 1200, 1400), ("c", 0, 50)]
    assert {r.k: (r.num_chunks, r.status) for r in chunks.log(df, ["k"]).collect()} == {"a": (2, "success"), "b": (0, "fail"), "c": (1, "success")}


def test_pages(spark):
    html = '<html><title>Privacy</title><a href="/a.pdf">Annual Report 2024</a><a href=\'b.pdf\'>Annual Report 2024</a><a href="/policy.pdf">x</a></html>'
    df = spark.createDataFrame([(1, "http://h.com/annual-report", html)], "page_id long, url string, html string")
    r = pages.candidates(df).first()
    assert (r.score, r.level, r.tags, r.pdf_count_on_page, r.best_pdf_url, r.best_pdf_score) == (17, "MEDIUM", "annual_report", 2, "http://h.com/a.pdf", 34)


def test_crawl_limits(spark):
    link = lambda *to: "".join(f'<a href="/{t}">investor</a>' for t in to)
    rows = [(i, f"http://b.com/{n}", link(*to)) for i, (n, to) in enumerate({"annual0": ["annual1", "annual2"], "annual1": ["annual3"], "annual2": ["annual3", "annual0"], "annual3": ["annual4"], "annual4": []}.items())]
    p = spark.createDataFrame(rows, "page_id long, url string, html string")
    banks = spark.createDataFrame([("1", "u", "http://b.com", "YES", "b.com/annual0"), ("2", "gntybank", "http://c.com", "YES", None), ("3", "w", "http://d.com", "NO", "x"), ("4", "v", "http://e.com", "YES", None)], files.BANKS)
    starts = crawl.start_urls(banks)
    assert {r.username: r.start_url for r in starts.collect()} == {"u": "https://b.com/annual0", "gntybank": "https://www.gnty.com/investors/"}
    s = starts.where("username = 'u'").select(F.col("username").alias("bank"), F.lit("http://b.com/annual0").alias("start_url"), "base_root", "entry_root")
    got = [(r.url[-1], r.depth, r.place) for r in crawl.crawl(s, p).orderBy("place").collect()]
    assert got == [("0", 0, 1), ("1", 1, 2), ("2", 1, 3), ("3", 2, 4)]
    assert crawl.crawl(s, p, max_pages=2).count() == 2


def test_downloads(spark):
    rows = spark.createDataFrame([("1", "a b", "http://x.com/annual-2024.pdf", -3.0), ("2", "c", "ftp://x", 5.0), ("3", "d", "http://x/y.pdf", -1.0), ("4", "e", " ", 1.0)], "idrssd string, username string, best_pdf_url string, score double")
    got = {r.idrssd: (r.status, r.year, r.local_path) for r in downloads.plan(downloads.prepare(rows), 2026).collect()}
    assert got == {"1": ("pending", "2024", "reports/other/2024/a_b_1/annual-2024pdf.pdf"), "2": ("skip_invalid_url", "unknown", ""), "3": ("skip_low_score", "unknown", "")}
    with pytest.raises(ValueError):
        downloads.prepare(rows.drop("username"))


def test_fetch():
    answers = iter([(500, "", b""), (200, "text/html", b""), (200, "text/html", b"x")])
    waits = []
    assert external.fetch_once("http://x/", lambda u: next(answers), wait=waits.append) == (True, "non_pdf_content_type:text/html", b"x") and waits == [1.0, 2.0]
    assert external.fetch_once("http://x", lambda u: 1 / 0, tries=1) == (False, "exception:ZeroDivisionError", None)
    assert external.fetch_once(" ", None) == (False, "empty_url", None)


def test_external(spark):
    urls = spark.createDataFrame([("http://a/x.pdf",), ("http://b",)], "url string")
    got = external.fetch_all(urls, lambda u: (200, "application/pdf", b"1")).collect()
    assert all(r.ok and r.reason == "ok" and bytes(r.content) == b"1" for r in got)
    docs = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a"), ("q", 1, None)], "path string, page int, text string")
    assert {r.path: r.text for r in external.joined_pages(docs).collect()} == {"p": "a\nb", "q": ""}
    layers = spark.createDataFrame([("http://x/", 1, None, "<html" + "y" * 800)], "url string, depth int, fast string, slow string")
    assert external.first_valid(layers, ["fast", "slow"], deep_only="slow").first().html is None
    assert external.first_valid(layers, ["fast", "slow"]).first().html is not None
    scans = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "path string, content binary")
    assert {r.path: r.ocr_status for r in external.recognised(scans, lambda raw: (0, b"x") if raw == b"1" else (3, b"")).collect()} == {"a": "success", "b": "copied"}


def test_retrieval(spark):
    ranked = spark.createDataFrame([("q", i, "b" if i in (201, 300, 500) else "o") for i in range(1, 600)], "query_id string, rank int, bank string")
    got = vectors.adaptive_k(ranked, F.col("bank") == "b", 10).orderBy("rank").collect()
    assert [(r.rank, r.k_used) for r in got] == [(201, 400), (300, 400)]
    hits = spark.createDataFrame([("t", 0.46), ("t", 0.44)], "target string, score double")
    assert [r.score for r in retrieval.laddered(hits, F.lit(0.5), ["target"]).collect()] == [0.46]
    every = spark.createDataFrame([("b", "s", i, f"t{i}") for i in range(6)], "bank string, stem string, chunk_id int, text string")
    hit = every.where("chunk_id = 2").withColumn("target", F.lit("t")).withColumn("score", F.lit(0.9)).withColumn("place", F.lit(1))
    out = retrieval.with_neighbours(hit, every, 1, ["target"]).orderBy("place").collect()
    assert [(r.chunk_id, round(r.score, 7)) for r in out] == [(2, 0.9), (1, 0.899999), (3, 0.899999)]
    assert "[k=b|stem=s|chunk=2]\n(rank=1 score=0.9000)\nt2" + V.BLOCK_BREAK in retrieval.context(retrieval.with_neighbours(hit, every, 1, ["target"]), ["target"]).first().context


H = "[k=a|stem=s|chunk={}]\n(rank=1 score=0.5)\n"


def test_extraction():
    assert extraction.find_nii(H.format(4) + "Net interest income (in thousands) 190,591") == ("190,591", "thousand", "4")
    assert extraction.find_nii(H.format(4) + "Net interest income (in thousands) 2024 190,591") is None
    assert extraction.find_nii("Net interest income 190,591") is None
    assert extraction.find_nim(H.format(1) + "our net interest margin was 3.63%") == ("3.63", "%", "[k=a|stem=s|chunk=1]")
    both = extraction.find_ratios(H.format(2) + "Return on average assets and equity were 1.99% and 8.69%, respectively, for 2024")
    assert {k: v[0] for k, v in both.items()} == {"ROA": "1.99", "ROE": "8.69"}
    table = "Summary of Operations:\nInterest Income\nNet Income\n2024\n291,043\n83,811\nAverage Balances:\nTotal Assets\nEquity\n2024\n8,000,000\n{}\nPer Share Data:"
    assert extraction.vertical_table(table, V.SUMMARY_TITLE, 2024, V.SUMMARY_STOPS) == {"Interest Income": 291043.0, "Net Income": 83811.0}
    assert extraction.compute_ratios(table.format("700,000"), 2024) == {}
    assert {k: v[0] for k, v in extraction.compute_ratios(table.format("1,000,000"), 2024).items()} == {"ROA": "1.05", "ROE": "8.38"}
    assert extraction.money_after("Average Assets in 2024\nwere 1,234,567 dollars", V.ASSET_LABELS) == 1234567.0


def test_answers():
    assert extraction.loose_json('so: {"a": [1, 2]} end') == {"a": [1, 2]}
    with pytest.raises(ValueError):
        extraction.loose_json("nothing")
    assert extraction.parsed_answer("The value is $190,591, unit: thousand; chunk 12", 2024)["value"] == "190591"
    assert extraction.normalised({"value": "5", "unit": "%", "source_chunk_id": "1"}, "ROA") == {"ROA": ("5", "%", "1")}
    assert extraction.normalised({"Return on Assets": "0.75%"}, "ROA")["ROA"][0] == "0.75%"


def test_plan(spark):
    text = "Net interest income (in thousands) 190,591 was up. Net interest margin was 3.63%"
    made = spark.createDataFrame([("b1", "AR_2024", 0, text), ("b2", "AR_2024", 0, "nothing here")], "bank string, stem string, chunk_id int, text string")
    made = made.withColumn("embedding", vectors.hashed_embedding(F.col("text")))

    def model(prompt):
        if "Find ROA" in prompt:
            raise RuntimeError("down")
        return '{"results":[{"metric_name":"Provision for Credit Losses","value":"5%","unit":"","source_chunk_id":"12"}]}'

    records, flat = plans.extract(["b1", "none"], made, 2024, model=model)
    got = {(r.bank, r.metric_name): (r.val, r.unit) for r in flat.collect()}
    assert got["b1", "NII"] == ("190,591", "thousand") and got["b1", "NIM"] == ("3.63", "%") and got["b1", "Provision for Credit Losses"] == ("5", "%") and got["b1", "ROA"] == ("NOT FOUND", "NOT FOUND")
    rows, counters = plans.report(records, 2024)
    assert {r.bank: (r.n_found, r.error) for r in rows.collect()} == {"b1": (3, ""), "none": (0, "NO_HITS")}
    assert {r.category: r.n for r in counters.collect()} == {"NO_HITS": 1, "FOUND_0": 1, "FOUND_GT0": 1}
    assert plans.answer_context("net interest margin", made).first().n_blocks == 1


def test_year_mismatch(spark):
    row = lambda cite: [("ROA", "1", "%", 2024, cite)]
    schema = "bank string, results array<struct<metric_name:string,value:string,unit:string,fiscal_year:int,source_chunk_id:string>>, year int, topk int, error string"
    df = spark.createDataFrame([("a", row("[k=a|stem=AR 2023|chunk=1]"), 2024, 1, ""), ("b", row("[k=a|stem=AR_2023|chunk=1]"), 2024, 1, ""), ("c", None, 2024, 1, "")], schema)
    got = {r.bank: (r.year_mismatch_metrics, r.status) for r in metrics.diagnosed(df, 2024).collect()}
    assert got == {"a": ("ROA", "OK"), "b": ("", "OK"), "c": ("", "RESULTS_NOT_LIST")}


def test_sources(spark, tmp_path):
    (tmp_path / "in" / "bank1").mkdir(parents=True)
    (tmp_path / "in" / "bank1" / "a.txt").write_text("line one\n\n" + "x" * 60)
    (tmp_path / "in" / "loose.txt").write_text("no")
    (tmp_path / "in" / "bank1" / "a.pdf").write_bytes(b"%PDF")
    (tmp_path / "ids.txt").write_text("a_1\n\n b_2 \n")
    got = files.read_texts(spark, str(tmp_path / "in")).collect()
    assert [(r.bank_folder, r.source_txt) for r in got] == [("bank1", "a")]
    assert files.read_pdfs(spark, str(tmp_path / "in")).count() == 1
    assert [r.value for r in files.read_lines(spark, str(tmp_path / "ids.txt")).collect()] == ["a_1", "b_2"]
    np.save(tmp_path / "m.npy", np.eye(3, dtype=np.float32))
    assert matrices.read_matrices(spark, str(tmp_path)).count() == 3
    df = spark.createDataFrame([("é", None)], "a string, b string")
    files.write_jsonl(df, str(tmp_path / "j"))
    assert files.read_jsonl(spark, str(tmp_path / "j"), "a string, b string").first().a == "é"
    files.write_csv(df, str(tmp_path / "c"), bom=True)
    assert next((tmp_path / "c").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbf")
    assert files.read_csv(spark, str(tmp_path / "c"), "a string, b string").first().a == "é"
    (tmp_path / "rules.json").write_text('{"positive_rules":[{"tag":"t","keywords":["k"],"weight":5}],"negative_keywords":["n"],"negative_penalty":8}')
    assert {(r.tag, r.keyword, r.points) for r in files.read_rules(spark, str(tmp_path / "rules.json")).collect()} == {("t", "k", 5), ("NEG", "n", -8)}
    for _ in range(2):
        ingest.chunk_stream(ingest.text_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_index(spark, tmp_path):
    df = spark.createDataFrame([("b", "s", i, [1.0, 0.0]) for i in range(3)], "bank string, stem string, chunk_id int, embedding array<float>")
    vectors.write_index(df, str(tmp_path / "ix"), 2)
    assert vectors.index_smoke(spark, str(tmp_path / "ix"))
    with pytest.raises(ValueError):
        vectors.write_index(df, str(tmp_path / "bad"), 3)
    with pytest.raises(ValueError):
        checks.same_size(df, df.limit(1))
    found = checks.artifacts(spark.createDataFrame([("a/b.pdf",), ("b.pdf",)], "path string"), {"pdf": r"\.pdf$", "txt": r"\.txt$"})
    assert {r.stage: (r.n_files, r.first_path, r.present) for r in found.collect()} == {"pdf": (2, "b.pdf", True), "txt": (0, None, False)}


def test_full_coverage_leaves_no_gap(spark):
    """Every character of texts of any length is in a chunk."""
    sizes = [1, 49, 99, 100, 101, 250, 1000, 1234, 5000, 30_001]
    texts = spark.createDataFrame([(n, "x" * n) for n in [*sizes, 0]] + [(-1, None)], "doc_id int, text string")
    got = {}
    for r in chunks.covered(texts, ["doc_id"], window=100, windows=None, size=40, overlap=10, most=None).collect():
        got.setdefault(r.doc_id, []).append((r.char_start, r.char_end))
    for n in sizes:
        at = 0
        for a, b in sorted(got[n]):
            assert a <= at
            at = max(at, b)
        assert at == n
    assert set(got) == set(sizes)
