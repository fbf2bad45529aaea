"""The corpus pipeline, each stage against a plain version on what the stage before has kept."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from factloom.llm import quality_crf
from test_llm_operators import plain_quality, prose

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h1 long, component string, start string, draw int, _ft_h1 string"


def shingles(words, k=5):
    return Counter(tuple(words[j : j + k]) for j in range(len(words) - k + 1)) or (Counter([tuple(words)]) if words else Counter())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    item, passage = prose(900, 40), prose(901, 60)
    near = prose(1, 150).split()
    texts = {
        1: " ".join(near), 2: " ".join(near), 3: " ".join([*near[:80], "changed", *near[81:]]), 4: prose(2, 80) + "\n" + passage, 5: passage + "\n" + prose(3, 90), 6: None, 7: "", 8: " \n\t", 9: "short text",
        10: "junk### ! " * 80, 11: prose(4, 3000), 12: prose(5, 70) + " " + item + " " + prose(6, 30), 13: prose(7, 60) + "\n" + prose(7, 60), 14: "a b c " * 60, 15: "é" * 300 + " " + prose(8, 60), 16: prose(9, 55),
    }
    rows = [(i, t, "en", None, None if t is None else len(t), 1, "c", "s", 1, "x") for i, t in texts.items()]
    rows += [rows[15], (None, prose(10, 60), None, None, None, None, None, None, None, None)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, item, "x"), (2, None, None), (3, "", "y")], "item_id long, text string, doc_id string").write.parquet(f"{at}/benchmark.parquet")
    return at


def kept(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_against_plain_versions(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    # 1: the rules; few labels, so the prior holds
    now = kept(docs)
    one = corpus_pipeline.quality_rules(spark, docs, tables).cache()
    want = Counter({k: n for k, n in now.items() if len((k[1] or "").split("\n")) < 15 and plain_quality(k[1] or "", quality_crf.PRIOR, quality_crf.PRIOR_STAY)[6]})
    assert kept(one) == want and one.columns == columns and not {6, 7, 8, 9, 10, 14} & {i for i, _ in want}
    # 2: the least id of each component of all pairs
    two = corpus_pipeline.near_duplicates(spark, one, tables).cache()
    ids = sorted({i for i, _ in want if i is not None})
    own = {i: set(shingles(re.findall(r"[^\x20\x09-\x0D]+", t.lower()))) for i, t in want if i is not None}
    least = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b]):
                    least[a] = min(least[a], least[b])
    want = Counter({k: n for k, n in want.items() if k[0] is None or least[k[0]] == k[0]})
    assert kept(two) == want and two.columns == columns and {2, 3}.isdisjoint(i for i, _ in want)
    # 3: strings of 51 words that stand twice, by all windows of words (no word is split here)
    three = corpus_pipeline.repeated_passages(spark, two, tables).cache()
    rows = [k for k, n in want.items() for _ in range(n)]
    words = [t.split() for _, t in rows]
    seen = Counter(tuple(w[j : j + 51]) for w in words for j in range(len(w) - 50))
    left = Counter()
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j + d for j in range(len(w) - 50) if seen[tuple(w[j : j + 51])] > 1 for d in range(51)}
        if len(gone) < len(w):
            left[i, tuple(x for j, x in enumerate(w) if j not in gone)] += 1
    got = Counter((i, tuple(t.split())) for (i, t), n in kept(three).items() for _ in range(n))
    assert got == left and three.columns == columns and all(r.n_chars is None or r.n_chars == len(r.text) for r in three.collect() if r.doc_id in (4, 5))
    # 4: items in any window, by exact similarity
    four = corpus_pipeline.benchmark_leaks(spark, three, tables).cache()
    item = prose(900, 40).split()

    def holds(t):
        w = t.lower().split()
        return any((shingles(w[a : a + 40]) & shingles(item)).total() / (shingles(w[a : a + 40]) | shingles(item)).total() >= 0.8 for a in range(max(1, len(w) - 39)))

    assert kept(four) == Counter({k: n for k, n in kept(three).items() if not holds(k[1])}) and 12 not in {r.doc_id for r in four.collect()}
    # 5: every id in one piece
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    pieces = Counter()
    for (i, t), n in kept(four).items():
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 2], "<u4")
        for a in range(0, len(ids), 4096):
            pieces[i, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())] += n
    packed = corpus_pipeline.packed(spark, four, tables).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    whole = corpus_pipeline.run(spark, tables).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in whole) == pieces


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
