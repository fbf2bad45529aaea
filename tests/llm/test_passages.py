"""Repeated passages by words: short ones of 51 words go, and nothing that is no passage."""

import random
import re

import corpus_pipeline
from factloom.llm import suffix_dedup

SCHEMA = "doc_id long, text string, n_chars int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(3)


def own(k: int, n: int) -> str:
    c = chr(0x100 + k)  # nothing before or after a passage is the same twice
    return " ".join(f"{c}own{i}{c}" for i in range(n))


def test_short_words(spark):
    rng = random.Random(5)
    passage = lambda n: " ".join(rng.choice("abcdefgé") for _ in range(n))
    p51, p50, glued, left, right, twice = passage(51), passage(50), passage(51), passage(40), passage(40), passage(51)
    texts = [f"{own(0, 9)} {p51} {own(1, 9)}", f"{own(2, 5)} {p51} {own(3, 70)}", f"{own(4, 9)} {p50} {own(5, 9)}", f"{own(6, 9)} {p50} {own(7, 9)}"]
    texts += [f'{own(8, 9)} {glued} {own(9, 9)}', f'{own(10, 9)} "{glued}" {own(11, 9)}']
    # two repeated strings of 40 words side by side are no repeated passage of 51
    texts += [f"{own(12, 9)} {left} {right} {own(13, 9)}", f"{own(14, 9)} {left} {own(15, 9)}", f"{own(16, 9)} {right} {own(17, 9)}", f"{own(18, 9)} {twice} {own(19, 9)} {twice}", twice]
    assert len(p51.encode()) < 240
    got = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, frame(spark, texts), "").collect()}
    want = dict(enumerate(texts))
    want |= {i: texts[i].replace(p51, "") for i in (0, 1)} | {i: texts[i].replace(glued, "") for i in (4, 5)} | {9: texts[9].replace(twice, "")}
    del want[10]
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_against_brute_force(spark):
    rng, words = random.Random(7), 4
    texts = ["".join(rng.choices(["a", "b", "é", "cd", " ", " ", "\n"], [4, 4, 2, 2, 1, 6, 1], k=rng.randrange(0, 90))) for _ in range(24)]
    texts += [texts[3], texts[5][4:40] + "x" + texts[6][2:30]]
    marks = [bytearray(len(t)) for t in texts]
    for x, t in enumerate(texts):
        for i in range(len(t)):
            for y, u in enumerate(texts):
                for j in range(len(u)):
                    if (x, i) != (y, j) and t[i] == u[j]:
                        n = 1
                        while i + n < len(t) and j + n < len(u) and t[i + n] == u[j + n]:
                            n += 1
                        s = t[i : i + n]
                        if len(s.split()) >= words:
                            a, b = i + len(s) - len(s.lstrip()), i + len(s.rstrip())
                            marks[x][a:b] = b"\1" * (b - a)
    got = {r.doc_id: r.text for r in suffix_dedup.without_passages(frame(spark, texts), words).collect()}
    for i, t in enumerate(texts):
        least = [c for c, m in zip(t, marks[i], strict=True) if not m and not c.isspace()]
        # of a word at the end of a passage more may go, if a shorter repeat holds it
        apart = [c for m in re.finditer(r"\S+", t) if not any(marks[i][m.start() : m.end()]) for c in m.group()]
        left = got.get(i, "")
        assert len(apart) <= len("".join(left.split())) <= len(least)
        assert left == t or any(marks[i])
