"""The operators on small tables with every awkward case: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import base64
import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from factloom.llm import chat_windows, decontaminate, hilbert_sharding, langid, minhash_dedup, packing, quality_crf, suffix_dedup, url_automaton, warc_segments
from factloom.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h1 string, key string, gram int, node int, shard int"
LOREM = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "so") for b in ("ban", "dor", "fen", "gul", "hip", "jot", "sam")]


def prose(seed: int, n: int) -> str:
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(LOREM[(x >> 33) % len(LOREM)] + str((x >> 50) % 30))
    return " ".join(out)


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 120)
    passage = prose(99, 80)
    texts = {
        1: base, 2: base, 3: base + " tail", 4: prose(2, 90) + "\n" + passage, 5: passage + "\n" + prose(3, 90), 6: None, 7: "", 8: " \n\t ", 9: "one two", 10: "one two", 11: prose(4, 20_000),
        12: "é" * 450, 13: "é" * 451 + "x", 14: ("junk### " * 60).strip(), 15: base.upper(), 16: prose(5, 300) + "\x1c\x85 Σ\x00",
    }
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i != 9 else None, len(t or ""), "clash", "clash", 1, 2, 3) for i, t in texts.items()]
    rows += [rows[0], (None, base, "en", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def local(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_sharding(docs, empty):
    got = hilbert_sharding.shard(docs, 8).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in local(docs))
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    text = dict(local(docs))
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in got)
    assert hilbert_sharding.shard(empty).count() == 0
    assert hilbert_sharding.manifest(hilbert_sharding.shard(docs, 8)).count() == 8


@pytest.mark.parametrize("kind", ["groups", "pairs", "giant"])
def test_shards_of_groups(spark, kind):
    """Against the law, the curve and the coordinates worked out in Python."""
    n = 1200
    copy = {"groups": lambda i: i % 300 if i < 900 else i, "pairs": lambda i: i // 2, "giant": lambda i: 0 if i % 3 == 0 else i}[kind]
    rows = [(i, f"text {copy(i)} " + "x" * (copy(i) * 7 % 500), ["en", "de", None, "fr"][i * i % 4], f"s{i * 31 % 40}") for i in range(n)]
    got = {r.doc_id: r for r in hilbert_sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5), 8, bucket_rows=100).collect()}
    assert sorted((r.shard, r.slot) for r in got.values()) == [(k, j) for k in range(8) for j in range(150)]
    groups = defaultdict(list)
    for i, t, _, _ in rows:
        groups[t].append(i)
    cut = [g for g in groups.values() if len({got[i].shard for i in g}) > 1]
    if kind == "giant":
        assert len(cut) == 1 and len(cut[0]) == 400
    elif kind == "groups":
        assert not cut
    else:  # nothing but pairs: one at each of the seven cuts may be split
        assert len(cut) <= 7
    for c, column in enumerate(("lang", "source")):
        values = sorted((r[2 + c] for r in rows), key=lambda v: (v is not None, v or ""))
        assert all(got[r[0]][f"q{c}"] == values.index(r[2 + c]) * 32 // n for r in rows), column
    assert [got[i].q2 for i in sorted(got, key=lambda i: got[i].size)] == sorted(r.q2 for r in got.values()) and len({r.q2 for r in got.values()}) > 20
    members = {i for g in groups.values() if 2 <= len(g) <= 9 for i in g}
    for r in got.values():
        if r.doc_id not in members:
            assert r.hilbert == hilbert_sharding.hilbert_index([[r.q0], [r.q1], [r.q2]], 5)[0]
    for k in range(8):
        run = [r.hilbert for r in sorted(got.values(), key=lambda r: r.slot) if r.shard == k]
        assert run == sorted(run)
    for g in groups.values():
        if 2 <= len(g) <= 9 and len({got[i].shard for i in g}) == 1:
            slots = sorted(got[i].slot for i in g)
            assert slots == list(range(slots[0], slots[0] + len(g)))


def plain_quality(text, weights, stay):
    """The columns after doc_id by the words of the contract; labels by trying all, where there are few lines, else by the scores of runs."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    repeated = len({j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)})
    seen, score, size = set(), [], []
    for line in lines:
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        mask = quality_crf.line_mask(line.encode(), [w.encode() for w in own], line in seen)
        score.append(sum(w for k, w in enumerate(weights) if mask >> k & 1))
        size.append(sum(len(w.encode()) for w in own))
        seen.add(line)
    assert len(lines) <= 14
    total = lambda y: (sum(s for s, v in zip(score, y, strict=True) if v) + stay * sum(a == b for a, b in zip(y, y[1:], strict=False)))
    labels = max(([k >> t & 1 for t in range(len(lines))] for k in range(1 << len(lines))), key=total)
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    share = sum(s for s, v in zip(size, labels, strict=True) if v) / sum(size) if lines else 0.0
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeated, failed, not failed and share >= 0.5, len(lines), sum(labels), share


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights, stay = quality_crf.fit(docs, labels)
    assert (weights, stay) == (quality_crf.PRIOR, quality_crf.PRIOR_STAY)
    more = [(200 + i, t) for i, t in enumerate(["a b c a b c a b c " * 3 + "x", "# $1 <b>|\n" * 4 + "word " * 60, "Good words in a line, and so on.\n" + "%%% ### %%%\n" * 3 + prose(9, 60), "one line\n\none line\r\n  one line\n" + prose(8, 70), "\n\x0b\x0c"])]
    docs = docs.unionByName(spark.createDataFrame([(i, t, *[None] * 8) for i, t in more], DOCS))
    got = quality_crf.judge(docs, weights, stay).collect()
    assert Counter(tuple(r) for r in got) == Counter((i, *plain_quality(t or "", weights, stay)) for i, t in local(docs))
    kept = quality_crf.judge(docs, weights, stay, keep_rows=True)
    assert kept.columns == docs.columns and 14 not in {r.doc_id for r in kept.collect()}
    assert quality_crf.judge(empty, weights, stay).count() == 0
    lines = [(i, "plain words here and there, in a sentence of some length." if i % 2 else "### *** junk$$$ %%% ###", "en", "s", 0, "", "", 0, 0, 0) for i in range(60)]
    fitted = quality_crf.fit(spark.createDataFrame(lines, DOCS), spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int"))
    node = quality_crf.Weights(fitted[0])
    assert quality_crf.viterbi(quality_crf.lines_of(lines[1][1].encode())[0], node, fitted[1]) == [True]
    assert quality_crf.viterbi(quality_crf.lines_of(lines[0][1].encode())[0], node, fitted[1]) == [False]


def gone_bytes(raw, length):
    counts = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        yield gone


@pytest.mark.parametrize(("length", "hot", "near", "piece"), [(100, 4096, 128, 2048), (400, 4096, 128, 2048), (400, 1, 128, 2048), (400, 2, 3, 200), (100, 4096, 0, 1)])
def test_suffix_dedup(docs, empty, length, hot, near, piece, monkeypatch):
    """Against all strings, with grams dealt with their neighbours, by themselves, and split."""
    monkeypatch.setattr(suffix_dedup, "NEAR", near)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup.spans, "__defaults__", (suffix_dedup.ANCHOR, 2000, hot))
    # a passage of which every document holds a part, in contexts of its own
    line = prose(123, 70)
    docs = docs.unionByName(docs.sparkSession.createDataFrame([(100 + k, f"{prose(300 + k, 10 + k)} {line[k : k + 380 + 9 * k]} {prose(400 + k, 40)}", *[None] * 8) for k in range(12)], DOCS))
    rows = local(docs)
    raw = [(t or "").encode() for _, t in rows]
    want = Counter()
    for (i, _), b, gone, short in zip(rows, raw, gone_bytes(raw, length), gone_bytes(raw, suffix_dedup.SHARED), strict=True):
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want[i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest(), sum(short)] += 1
    assert Counter(tuple(r) for r in suffix_dedup.report(docs, length).collect()) == want
    if length == 400 and hot == 4096:
        assert suffix_dedup.report(empty, length).count() == 0
        out = suffix_dedup.without_repeats(docs, length)
        assert out.columns == docs.columns
        left = {r.doc_id: r.text for r in out.collect()}
        assert 1 not in left and left[6] is None and prose(99, 80)[:200] not in left[4] and left[11] == dict(rows)[11]


def test_chat(spark):
    nasty = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "system", "be <kind> # \\b"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (1, 3, "user", None), (1, 4, None, "x"), (1, 5, "a: b\n\\n", "y\n"), (1, 6, "assistant", "word " * 900), (1, 7, "assistant", ""), (2, 0, "assistant", "é😀"), (2, 0, "assistant", "é😀"), (2, None, "user", "first"), (3, 1, "system", "late")]
    rows += [(4, k, "user" if k % 2 else "assistant", prose(k, 60)) for k in range(40)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, window string")
    formatted = chat_windows.windows(df).cache()
    got = {r.conv_id: r for r in chat_windows.digests(formatted).collect()}
    assert len(got) == 4 and got[4].n_windows > 5
    for conv, r in got.items():
        own = sorted(((t is not None, t or 0, ro or "", te or "") for c, t, ro, te in rows if c == conv))
        said = "".join(f"{ro}\n{te}\n" for _, _, ro, te in own)
        loss = "".join(te for _, _, ro, te in own if ro == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for w in formatted.where("conv_id = 1 and window > 1").collect():
        assert w.formatted.startswith("### system: be \\lkind> \\h \\bb</turn>\n") and w.n_repeated >= 1
    assert all(w.n_tokens <= chat_windows.BUDGET for w in formatted.where("conv_id = 4").collect())
    assert chat_windows.digests(chat_windows.windows(df.where("false"))).count() == 0


def plain_windows(sizes, system, budget, history):
    """New and repeated turns of each window, turn by turn; system: the first turn is one."""
    sys = sizes[0] if system else 0
    room = max(0, budget - sys)
    past = min(history, room // 4)
    stride = max(1, (room - past) // 2)
    spans, start, cell, alone = [], 0, None, False
    for k, n in enumerate(sizes):
        if system and k == 0:
            spans.append([k])
            continue
        joins = spans and ((system and k == 1) or (not alone and n <= stride and start // stride == cell))
        spans[-1].append(k) if joins else spans.append([k])
        cell, alone, start = start // stride, n > stride, start + n
    out = []
    for i, new in enumerate(spans):
        left = min(past, room - sum(sizes[k] for k in new if not (system and k == 0)))
        again = []
        for k in reversed(spans[i - 1] if i else []):
            left -= sizes[k]
            if left < 0 or (system and k == 0):
                break
            again.insert(0, k)
        out.append((new, ([0] if system and i else []) + again))
    return out


def test_chat_budget(spark):
    sizes = {1: (0, [380, 900, 250]), 2: (0, [900, 252]), 3: (1, [800, *[100] * 9]), 4: (1, [600, *[60] * 30, 500, 900, 20, 20]), 5: (1, [1100, 30, 40, 2000]), 6: (0, [384] * 5), 7: (0, [385] * 5), 8: (0, [30, 2000, 30]), 9: (1, [10])}
    sizes |= {100 + j: (j % 2, [1 + (j * 7919 + k * k * 104729) % (50 + 97 * (j % 9)) + 10 for k in range(40)]) for j in range(20)}
    # a turn of n tokens: the markers have 14 to 19 code points
    rows = [(c, k, "system" if system and k == 0 else "user", "x" * (4 * n - len(f"### {'system' if system and k == 0 else 'user'}: </turn>\n"))) for c, (system, own) in sizes.items() for k, n in enumerate(own)]
    got = defaultdict(list)
    for w in chat_windows.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "window").collect():
        got[w.conv_id].append(w)
    for c, (system, own) in sizes.items():
        want = plain_windows(own, system, chat_windows.BUDGET, chat_windows.HISTORY)
        assert [(w.n_turns - w.n_repeated, w.n_repeated, w.n_tokens) for w in got[c]] == [(len(n), len(r), sum(own[k] for k in n + r)) for n, r in want], c
        for (new, _), w in zip(want, got[c], strict=True):
            turns = [k for k in new if not (system and k == 0)]
            assert w.n_tokens <= chat_windows.BUDGET or (len(turns) <= 1 and sum(own[k] for k in turns) + (own[0] if system else 0) == w.n_tokens > chat_windows.BUDGET)


def test_minhash(docs, empty):
    rows = local(docs)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = {}
    for i, t in rows:
        w = word.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    link = {i: i for i in sets if i is not None}
    for _ in link:
        for a in link:
            for b in link:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    link[a] = min(link[a], link[b])
    got = Counter(tuple(r) for r in minhash_dedup.dedup(docs, 4, 80).collect())
    assert got == Counter((i, len(sets[i]), link.get(i), i is None or link[i] == i) for i, _ in rows)
    assert minhash_dedup.dedup(empty, 4, 80).count() == 0
    kept = minhash_dedup.representatives(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {None, 1, 4} and 2 not in {r.doc_id for r in kept.collect()}


def test_minhash_across_components(spark):
    # near copies whose smallest id links with none of them directly, and blocks of one member
    words = prose(50, 200).split()
    rows = [(k, " ".join([*words[:10 + 3 * k], *prose(k, 30).split(), *words[10 + 3 * k :]])) for k in range(12)]
    rows += [(100 + k, " ".join(words + prose(200 + k, k * 4).split())) for k in range(14)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    link = {i: i for i in sets}
    for _ in link:
        for a in link:
            for b in link:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    link[a] = min(link[a], link[b])
    got = {r.doc_id: r.component_id for r in minhash_dedup.dedup(df, block=3).collect()}
    assert got == link


def test_packing(docs, empty):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    got = packing.pack_documents(docs, path, 2, sequence=512, group_pieces=5).collect()
    plain, text = Tokenizer.from_file(path), dict(local(docs))
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 512
    for i, p in pieces.items():
        ids = [*plain.encode(text[i] or "", add_special_tokens=False).ids, 2]
        assert {d for _, _, d in p} == {len(ids)}
    # every id of every row in one piece, by its place and checksum
    want = Counter()
    for i, t in local(docs):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.update((i, a, len(ids[a : a + 512]), zlib.crc32(ids[a : a + 512].tobytes()), len(ids)) for a in range(0, len(ids), 512))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    with_ids = packing.pack_documents(docs, path, 2, sequence=512, group_pieces=5, with_ids=True).collect()
    assert Counter((r.doc_id, r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in with_ids) == Counter((i, a, c) for (i, a, _, c, _), n in want.items() for _ in range(n))
    one = packing.pack_documents(docs, path, 2, sequence=512, group_pieces=1000).collect()
    full = sum(r.length for r in one) / (512 * len({r.sequence_id for r in one}))
    assert full > 0.97
    assert packing.pack_documents(empty, path, 2).count() == 0


def test_decontamination(spark, docs, empty):
    text = dict(local(docs))
    item = " ".join(text[11].split()[500:540])
    bench = spark.createDataFrame([(1, item, "x"), (1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "One TWO", "x"), (5, prose(77, 30), "x")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, bench).collect()}
    assert got == {(11, 1), (9, 4), (10, 4)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs, bench, index_bytes=200).collect()} == got
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {i for i, _ in local(docs)} - {r.doc_id for r in kept.collect()} == {9, 10, 11}
    assert decontaminate.find(empty, bench).count() == 0 and decontaminate.find(docs, bench.where("false")).count() == 0


def test_decontamination_against_all_windows(spark):
    """Every window of every document against every item, by exact similarity: all clear hits are found, with the best window, and nothing else."""
    base = prose(600, 4000).split()
    items = {k: base[97 * k : 97 * k + 12 + 5 * k] for k in range(20)}
    texts = {}
    for k, words in items.items():
        w = [f"x{k}" if k % 4 and j % (9 + k) == 3 and j < k else x for j, x in enumerate(words)]
        texts[k] = prose(700 + k, 30 + k).split() + w + prose(800 + k, 25).split() + (words[: 8 + k] if k % 3 == 0 else [])
    shingles = lambda w: Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    want = {}
    for d, t in texts.items():
        for k, words in items.items():
            own, best = shingles(words), (0.0, 0)
            for a in range(len(t) - len(words) + 1):
                there = shingles(t[a : a + len(words)])
                both = (own & there).total() / (own | there).total()
                best = max(best, (both, -a))
            if best[0] >= 0.8:
                want[d, k] = (-best[1], len(words), best[0])
    frame = lambda rows, schema: spark.createDataFrame([(k, " ".join(w)) for k, w in rows.items()], schema).repartition(3)
    got = {(r.doc_id, r.item_id): (r.start_word, r.n_words, r.similarity) for r in decontaminate.find(frame(texts, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()}
    assert got == want and 8 < len(want) < 20


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "http://c/\r\nX: y", ""), (5, "http://d/", "é" * 40_000 + "\r\n\r\nWARC/1.1\r\n"), (5, "http://d/", "é" * 40_000 + "\r\n\r\nWARC/1.1\r\n"), (None, "u", "null id")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    warc_segments.write_archives(df, str(tmp_path / "w"))
    records = warc_segments.read_records(spark, str(tmp_path / "w"))
    assert records.where("type = 'continuation'").count() > 3
    got = warc_segments.summary(warc_segments.reassembled(records)).collect()
    assert len(got) == len(rows) and all(r.error is None for r in got)
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got if r.page_id != 5} == {
        (1, 4, sha("same"), "revisit", 2), (2, 4, sha("same"), "response", None), (3, 0, sha(""), "revisit", 4), (4, 0, sha(""), "response", None), (None, 7, sha("null id"), "response", None)}
    assert sorted((r.record_type, r.refers_to) for r in got if r.page_id == 5) == [("response", None), ("revisit", 5)]
    broken = records.where("not (type = 'continuation' and number = 2)")
    assert {r.error for r in warc_segments.reassembled(broken).where("type = 'response' and page_id = 5").collect()} == {"segments missing"}
    cutshort = records.withColumn("block", F.expr("case when type = 'continuation' and number = 2 then substring(block, 2) else block end"))
    assert {r.error for r in warc_segments.reassembled(cutshort).where("type = 'response' and page_id = 5").collect()} == {"total length"}
    warc_segments.write_archives(df.where("false"), str(tmp_path / "e"))
    assert warc_segments.read_records(spark, str(tmp_path / "e")).count() == 0


def test_warc_of_others(spark, tmp_path):
    """Archives that others wrote: a gzip member for each record, damaged records, files cut off."""
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    plain = lambda k, body, size=None: (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r{k}>\r\nX-Page-Id: {k}\r\nWARC-Payload-Digest: sha1:{sha(body)}\r\nContent-Length: {len(body) + 19 if size is None else size}\r\n\r\n").encode() + b"HTTP/1.1 200 OK\r\n\r\n" + body + b"\r\n\r\n"
    folder = tmp_path / "a"
    folder.mkdir()
    (folder / "1.warc.gz").write_bytes(b"".join(gzip.compress(plain(k, b"body %d" % k)) for k in range(3)))
    (folder / "2.warc.gz").write_bytes(gzip.compress(plain(3, b"x") + b"noise without an end\r\n\r\nmore\r\n" + plain(4, b"y") + plain(5, b"z", "many") + plain(6, b"cut", 500)))
    (folder / "3.warc.gz").write_bytes(gzip.compress(plain(7, b"u" * 5000))[:-30])
    (folder / "4.warc.gz").write_bytes(b"no gzip at all")
    (folder / "5.warc.gz").write_bytes(gzip.compress(plain(8, b"a" * 3000)) + gzip.compress(plain(9, b"b"))[:-9])
    got = warc_segments.reassembled(warc_segments.read_records(spark, str(folder))).collect()
    good = {r.page_id: bytes(r.payload) for r in got if r.error is None}
    assert good.items() >= {0: b"body 0", 1: b"body 1", 2: b"body 2", 3: b"x", 4: b"y", 8: b"a" * 3000}.items() and good.keys() <= {0, 1, 2, 3, 4, 8, 9}
    assert Counter(r.error for r in got if r.error) >= Counter({"no record": 2, "block cut off": 1, "damaged file": 3})


def test_langid(spark, docs, empty):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.predict(big, langid.fit(big)).join(big.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.where("lang = lang_pred").count() >= 0.97 * out.count() > 0
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert got[6].lang_pred == got[7].lang_pred == "und" and got[1].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None)
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    # an id that stands many times is no way around the bound
    many = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("words in a row "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    assert langid.sample(many, 50).count() == 50
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}


def test_urls(spark):
    urls = {"http://A.Example.com/en/7x?q#f": ("a.example.com", "/en/7x", "example.com/en/7", "allow"), "http://example.com/en/8": ("example.com", "/en/8", "com/en/", "block"), "https://m.example.net/de/81": ("m.example.net", "/de/81", "example.net/de/8", "block"),
            "x://net/de/": ("net", "/de/", "net/de/", "allow") , "http://notnet/de/": ("notnet", "/de/", None, "allow"), "http://a.org/x.com/en/": ("a.org", "/x.com/en/", None, "allow"), "http://h/a.zip": ("h", "/a.zip", None, "block"), "no url": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://h?x://com/en/": ("h", "", None, "allow")}
    rules = [(h, p, "allow" if (h, p) == ("net", "/de/") else v) for h, p, v in url_automaton.RULES]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_automaton.judge(df, rules).collect()}
    assert list(got[i] for i in range(len(urls))) == list(urls.values())
    assert url_automaton.judge(df.where("false")).count() == 0


def test_the_rules_are_those_of_the_contract(spark):
    assert set(url_automaton.RULES) == {("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")}
    urls = {"http://com/en/": "block", "http://a.com/en/x": "block", "http://example.com/en/7": "allow", "http://net/de/": "allow", "http://b.net/de/7": "allow", "http://net/de/ads/x.zip": "allow", "http://example.net/de/7": "allow", "http://example.net/de/8": "block", "http://c.org/es/": "block"}
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_automaton.judge(df).collect()} == dict(enumerate(urls.values()))


def test_pipeline_and_queries(spark):
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert out and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "benchmark_leaks", "packed"]


@pytest.mark.parametrize("sizes", [[40], [250], [249, 200, 100, 33], [250] * 8, [125] * 15 + [17] * 3, [16, 15, 2, 2, 2], [300, 250]])
def test_groups_that_fit_stay_whole(spark, sizes):
    """Of 2000 rows in eight shards any group of up to 250; a larger one is cut, and nothing else."""
    texts = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)]
    texts += [f"single {i}" for i in range(2000 - len(texts))]
    rows = [(i if i % 7 else None, t, ["en", "de", None][len(t) * i % 3], f"s{i % 11}") for i, t in enumerate(texts)]
    got = hilbert_sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6), 8, bucket_rows=90).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(k, j) for k in range(8) for j in range(250)]
    where = defaultdict(set)
    for r in got:
        where[r.text_crc32].add(r.shard)
    assert [len(where[zlib.crc32(f"group {g}".encode())]) == 1 for g in range(len(sizes))] == [n <= 250 for n in sizes]


IDS = [None, 1 << 60, (1 << 60) + 1, -(1 << 63), (1 << 63) - 1, 10**18, 10**18 + 5, -1, 0]


def test_long_ids_beside_null(spark):
    """No id is rounded or lost, whatever stands beside it."""
    import public_tokenizers

    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(IDS)], "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted(IDS, key=str)
    pages = spark.createDataFrame([(i, f"http://h{k}.org/es/", f"<p>{k % 4}</p>") for k, i in enumerate(IDS)], "page_id long, url string, html string").coalesce(1)
    assert sorted((r.page_id for r in url_automaton.judge(pages).collect()), key=str) == sorted(IDS, key=str)


def test_archives_of_long_ids(spark, tmp_path):
    ids = [i for i in IDS if i is not None]
    pages = spark.createDataFrame([(i, f"http://h{k}.org/", f"<p>{k % 3}</p>") for k, i in enumerate(ids)], "page_id long, url string, html string")
    warc_segments.write_archives(pages, str(tmp_path / "w"), min_revisit=0)
    got = {r.page_id: r.refers_to for r in warc_segments.summary(warc_segments.reassembled(warc_segments.read_records(spark, str(tmp_path / "w")))).collect()}
    best = {k: max(i for j, i in enumerate(ids) if j % 3 == k) for k in range(3)}
    assert got == {i: None if best[k % 3] == i else best[k % 3] for k, i in enumerate(ids)}


def thue_morse(n, swap):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_fool_polynomial_hashes(spark, n):
    """Words of one polynomial hash modulo 2**64 are different words: no links, no leaks, whole sets."""
    x, y = thue_morse(n, 0), thue_morse(n, 1)
    docs = spark.createDataFrame([(1, " ".join([x] * 9)), (2, " ".join([y] * 9)), (3, " ".join([x, y, x, x, y, y, x, y, x])), (4, " ".join([y, x, y, y, x, x, y, x, y])), (5, " ".join([x] * 9))], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.dedup(docs, 4).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (6, 3), 4: (6, 4), 5: (1, 1)}
    items = spark.createDataFrame([(7, " ".join([y] * 9))], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.find(docs, items).collect()] == [2]
