"""Token counts against the library that the tokenizer file is for."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from factloom.llm import token_automaton
from factloom.llm.common import text_buffer
from factloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
HAND = [
    "", "a", "  ", "a  b", "'s", "x's 'll'll 'l 're'r", "it's o'clock ''s '' 'x 'S", "  'sfoo \n\n bar\n", "\n foo\r\n\t", "12 34a5 !? é日本語 😀😀a½", "don't　 　x\x85\x1c",
    "<|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext|>z<|endof", "<|endof", "text|>", "   ", " " * 50 + "x", "a" * 4000, "́e‍", "\x00",
]
ALPHABETS = ["abce'srvlmtd ", " \n\t a1'!　 é", "abcdefghijklmnopqrstuvwxyz ", "aeiotn", "a", "ethion's 19", "<|endoftext|> "]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return token_automaton.TokenCounter(PATH, token_automaton.character_runs(PATH))


def counts(counter, texts):
    return counter.counts(*text_buffer(pa.array(texts, pa.string()))).tolist()


def test_hand_and_random_texts(counter, library):
    r = random.Random(5)
    texts = HAND + ["".join(r.choice(a) for _ in range(r.randrange(250))) for a in ALPHABETS for _ in range(300)]
    assert counts(counter, texts) == library(texts)


def test_every_kind_of_character(counter, library):
    r = random.Random(6)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, r.sample(points, 60))) for _ in range(400)] + ["a" + chr(c) + "1" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert counts(counter, texts) == library(texts)


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_blocks_carry_their_state(counter, library, monkeypatch, block):
    monkeypatch.setattr(token_automaton, "BLOCK", block)
    r = random.Random(block)
    texts = HAND + ["".join(r.choice(a) for _ in range(r.randrange(90))) for a in ALPHABETS for _ in range(8)]
    assert counts(counter, texts) == library(texts)


def test_beginning_anew(counter, library, monkeypatch):
    monkeypatch.setattr(token_automaton, "BLOCK", 50)
    monkeypatch.setattr(token_automaton, "MOST_STATES", 30)
    r = random.Random(8)
    texts = ["".join(r.choice("aeiotn' ") for _ in range(r.randrange(300))) for _ in range(60)]
    assert counts(counter, texts) == library(texts)


def test_scan_equals_one_chunk_at_a_time():
    r = np.random.default_rng(3)
    for n in (1, 31, 32, 33, 1000):
        kinds = r.integers(0, 11, n).astype(np.uint8)
        for state in range(11):
            starts, last, earlier = token_automaton.piece_starts(kinds, state)
            now, plain = state, np.zeros(n + 1, bool)
            for i, c in enumerate(kinds):
                plain[i + 1] |= token_automaton.HERE[now, c] == 1
                plain[i] |= token_automaton.BEFORE[now, c] == 1
                now = int(token_automaton.TO[now, c])
            assert (starts == plain[1:]).all() and last == now and earlier == plain[0]


def test_query_parts(spark, library):
    texts = [None, *HAND, "long " * 40_000, "é" * 100_000]
    ids = [None, 1 << 60, (1 << 60) + 1, -(1 << 63), (1 << 63) - 1, -1, *range(len(texts) - 6)]
    rows = [(i, t, 1, "clash", True) for i, t in zip(ids, texts, strict=True)]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, n_bytes string, over_limit boolean").repartition(3)
    got = sorted(map(tuple, token_automaton.count(docs, PATH).collect()), key=repr)
    n = library([t for _, t, *_ in rows])
    assert got == sorted(((i, len((t or "").encode()), k, k > 1024) for (i, t, *_), k in zip(rows, n, strict=True)), key=repr)
    assert token_automaton.count(docs.where("false"), PATH).collect() == []


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in QUERIES["op13_token_automaton"](spark, sf).collect()}
    assert got == {d.doc_id: (len(d.text.encode()), n) for d, n in zip(docs, library([d.text for d in docs]), strict=True)}
