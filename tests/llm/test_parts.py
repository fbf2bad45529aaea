"""The parts without Spark against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import common, decontaminate, hilbert_sharding, induced_sort, langid, minhash_dedup, packing, quality_crf, suffix_dedup, url_automaton, warc_segments


def test_hilbert_is_a_curve():
    side = 8
    grid = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    at = hilbert_sharding.hilbert_index(list(grid.T), 3)
    assert sorted(at) == list(range(side**3))
    path = grid[np.argsort(at)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=80), st.integers(1, 6), st.sampled_from([0, 4, 1 << 20]), st.sampled_from([1, 7, 1 << 16]), st.sampled_from([1, 9, 1 << 20]), st.sampled_from([2, 1 << 20]), st.sampled_from([1, 2, 10]), st.data())
def test_repeated_starts(symbols, length, base, block, memory, naming, digit, data):
    text = [*symbols, 0]
    owned = np.array(data.draw(st.lists(st.booleans(), min_size=len(text), max_size=len(text))))
    held = induced_sort.BLOCK, induced_sort.NAMING, induced_sort.DIGIT_BITS, induced_sort.CHUNK
    induced_sort.BLOCK, induced_sort.NAMING, induced_sort.DIGIT_BITS, induced_sort.CHUNK = block, naming, digit, 3 * block
    try:
        space = induced_sort.Space(memory=memory, base=base)
        every, _ = induced_sort.repeated_starts(np.array(text, np.uint16), 4, (length, length + 3), space)
        some, more = induced_sort.repeated_starts(np.array(text, np.uint16), 4, (length, length + 3), space, owned)
        order, prefix = induced_sort.InducedSort(np.array(text, np.uint16), 4, 1000, space).arrays()
    finally:
        induced_sort.BLOCK, induced_sort.NAMING, induced_sort.DIGIT_BITS, induced_sort.CHUNK = held
    n = len(text)
    for got, own, size in ((every, [True] * n, length), (some, owned, length), (more, owned, length + 3)):
        counts = Counter(tuple(text[i : i + size]) for i in range(n - size + 1) if own[i])
        assert got.tolist() == [i + size <= n and bool(own[i]) and counts[tuple(text[i : i + size])] > 1 for i in range(n)]
    assert order.tolist() == sorted(range(n), key=lambda i: text[i:])
    for k in range(1, n):
        a, b = text[order[k - 1] :], text[order[k] :]
        assert prefix[k] == next(i for i in range(n) if a[i : i + 1] != b[i : i + 1])


def test_sort_spills_and_recurses_with_the_sizes_as_set(tmp_path):
    rng = np.random.default_rng(1)
    words = [rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint16) for _ in range(3000)]
    space32 = np.array([32], np.uint16)
    body = np.concatenate([x for w in rng.integers(0, 3000, 700_000) for x in (words[w], space32)])[: 4 << 20]
    body[1_500_000:1_500_900] = body[200_000:200_900]
    text = np.append(body, np.uint16(0))
    space = induced_sort.Space(str(tmp_path))
    (found,) = induced_sort.repeated_starts(text, 258, (400,), space)
    assert np.flatnonzero(found).tolist() == [*range(200_000, 200_501), *range(1_500_000, 1_500_501)]
    assert space.spills > 20 and space.recursions > 0


@settings(deadline=None, max_examples=150)
@given(st.binary(max_size=150), st.integers(4, 24), st.integers(1, 4))
def test_anchors_own_each_window_once_and_alike(raw, length, gram):
    h, p, a, b = suffix_dedup.anchors(np.frombuffer(bytes(x % 3 for x in raw), np.uint8), length, gram)
    raw = bytes(x % 3 for x in raw)
    own, seen = {}, {}
    for hh, pp, lo, hi in zip(h.tolist(), p.tolist(), a.tolist(), b.tolist(), strict=True):
        for w in range(lo, hi + 1):
            assert w not in own
            own[w] = (hh, pp - w)
    assert sorted(own) == list(range(max(0, len(raw) - length + 1)))
    for w, o in own.items():
        assert seen.setdefault(raw[w : w + length], o) == o


def test_runs():
    assert suffix_dedup.runs([(5, 7), (0, 3), (3, 4), (6, 9)]) == [(0, 4), (5, 9)]
    raw = np.frombuffer("aéé".encode(), np.uint8)
    assert suffix_dedup.at_code_points(raw, [(2, 4)]) == [] and suffix_dedup.at_code_points(raw, [(1, 4)]) == [(1, 3)]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(0, 15), max_size=8), st.integers(-2000, 2000), st.integers(0, 1500))
def test_viterbi(masks, weight, stay):
    node = quality_crf.Weights([weight, 500, -700, 300])
    score = lambda y: sum(node[m] for m, v in zip(masks, y, strict=True) if v) + stay * sum(a == b for a, b in zip(y, y[1:], strict=False))
    got = quality_crf.viterbi(masks, node, stay)
    best = max(score([k >> i & 1 for i in range(len(masks))]) for k in range(1 << len(masks)))
    assert len(got) == len(masks) and score(got) == best


def test_forward_backward_against_enumeration():
    """The likelihood of the observed qualities, and its gradient, from all label sequences."""
    rng = np.random.default_rng(3)
    masks = [tuple(int(m) | 1 for m in rng.integers(0, 1 << len(quality_crf.FEATURES), n)) for n in (1, 2, 5, 3, 4)]
    quality = [0, 1, 1, 0, 1]
    chains = quality_crf.Chains(masks, quality)
    lines = {q: sum(len(m) for m, k in zip(masks, quality, strict=True) if k == q) for q in (0, 1)}

    def plain(w):
        total = -0.5 * float(w @ w)
        for m, q in zip(masks, quality, strict=True):
            x = np.array([[k >> i & 1 for i in range(len(quality_crf.FEATURES))] for k in m], float) @ w[:-1]
            with_, without = 0.0, 0.0
            for y in range(1 << len(m)):
                label = [y >> t & 1 for t in range(len(m))]
                score = np.exp(sum(x[t] for t in range(len(m)) if label[t]) + w[-1] * sum(a == b for a, b in zip(label, label[1:], strict=False)))
                without += score
                with_ += score * np.prod([1 - quality_crf.LINE_NOISE if v == q else quality_crf.LINE_NOISE for v in label])
            total += 1000 / lines[q] * (np.log(with_) - np.log(without))
        return total

    w = rng.normal(0, 0.5, len(quality_crf.FEATURES) + 1)
    value, slope = chains.objective(w)
    assert abs(value - plain(w)) < 1e-6
    for k in range(len(w)):
        e = np.zeros_like(w)
        e[k] = 1e-5
        assert abs((plain(w + e) - plain(w - e)) / 2e-5 - slope[k]) < 1e-3 * max(1, abs(slope[k]))


@given(st.lists(st.sampled_from("abc"), max_size=30))
def test_repeat_words(letters):
    words = [x.encode() for x in letters]
    n = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if n[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    assert quality_crf.repeat_words(words) == len(covered)


def test_judge_text_edges():
    node = quality_crf.Weights(quality_crf.PRIOR)
    for text in (None, "", " \n\t"):
        r = quality_crf.judge_text(text, node, 1000)
        assert r[:5] == (0, 0, 0, 0, 0) and r[5] is True and r[6] is False
    r = quality_crf.judge_text("a b\x0bc é\na b\x0bc é\n\n", node, 1000)
    assert r[:4] == (8, 8, 0, 1) and r[4] == 8


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_first_fit_decreasing(lengths):
    bins, offsets = packing.first_fit_decreasing(np.array(lengths, np.int64), 100)
    free, plain = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        k = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        if k == len(free):
            free.append(100)
        plain[i] = (k, 100 - free[k])
        free[k] -= lengths[i]
    assert {i: (int(bins[i]), int(offsets[i])) for i in range(len(lengths))} == plain


def test_word_tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    ours, theirs = packing.WordTokenizer(path, memo=20), Tokenizer.from_file(path)
    rng = random.Random(5)
    pool = "aAbÉéßİΣσς'sReT09½ \t\n\x1c\x85\xa0 .,!-_<|>endoftext日語한é😀\x00﻿"
    for k in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) + " <|endoftext|>" * (k % 7 == 0)
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_automaton():
    import re

    globs = ["*.com/en/**", "**/ads/**", "*/login", "**.zip", "a*b**c" * 16]
    machine = url_automaton.Automaton(globs)
    assert machine.words > 1
    rules = [re.compile("".join({"**": r".*", "*": r"[^/]*"}.get(x) or re.escape(x) for x in re.findall(r"\*\*|\*|[^*]+", g)), re.S) for g in globs]
    rng = random.Random(3)
    texts = ["", ".x.com/en/", ".x/y.com/en/z", "/ads/", "h/login", "a/b/login", "é.zip", "abcabc" * 16] + ["".join(rng.choice("abc/.comenadslogizp") for _ in range(rng.randint(0, 90))) for _ in range(2000)]
    texts += ["aXbYc" * 16, "abc" * 16]
    got = machine.accepts([t.encode() for t in texts])
    assert got.tolist() == [[bool(r.fullmatch(t)) for r in rules] for t in texts]
    assert url_automaton.Automaton([]).accepts([b"x"]).shape == (1, 0)


@given(st.text(max_size=200), st.integers(4, 50))
def test_chunked_framing(text, size):
    assert warc_segments.dechunked(warc_segments.chunked(text, size).encode()) == text.encode()
    assert "".join(warc_segments.pieces(text, size)) == text


def test_records_parse():
    page = warc_segments.records_of("1", 7, "http://x/", "D", "é" * 500 + "\r\n\r\nWARC/1.1", None, 200)
    raw = "".join(r + warc_segments.END for r in page).encode()
    found = list(warc_segments.parse(warc_segments.Window([raw])))
    assert len(found) == len(page) > 3 and found[-1][0]["warc-segment-total-length"] == str(sum(len(b) for _, b, _ in found))


def test_multi_index_shares_a_key_within_the_distance():
    allowed = minhash_dedup.allowances(26)
    assert sum(a + 1 for a in allowed) == 27 and len(allowed) == minhash_dedup.CHUNKS
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = rng.integers(0, 1 << 15, 64)
        y = x.copy()
        change = rng.choice(64, 26, replace=False)
        y[change] ^= 1 + rng.integers(0, 100, 26)
        pack = lambda v: [sum(int(s) << (15 * i) for i, s in enumerate(v[4 * c : 4 * c + 4])) for c in range(16)]
        keys = lambda v: {(c, m, v[c] & m) for c, a in enumerate(allowed) if a >= 0 for m in minhash_dedup.blanks(a)}
        assert keys(pack(x)) & keys(pack(y))


def test_signature_estimates_similarity():
    pool = common.mix(np.arange(1, 20001, dtype=np.uint64))
    a, b = pool[:900], np.concatenate((pool[:800], pool[5000:5100]))
    both, to = np.concatenate((a, b)), np.array([0, 900, 1800])
    s = minhash_dedup.signatures(both, to)
    lanes = np.stack([(s >> (15 * k)) & 32767 for k in range(4)], 2).reshape(2, 64)
    assert abs((lanes[0] == lanes[1]).mean() - 0.8) < 0.17


def components_of(n, links, start):
    own = list(start)
    for _ in range(n):
        for a, b in links:
            own[a] = own[b] = min(own[a], own[b])
    return own


@pytest.mark.parametrize("seed", range(6))
def test_links_of_a_hub(seed):
    rng = random.Random(seed)
    hub = set(range(80))
    sets = [(hub - set(rng.sample(range(80), rng.randint(0, 25)))) | set(rng.sample(range(100, 130), rng.randint(0, 20))) for _ in range(60)]
    order = sorted(hub)
    rows = []
    for i, s in enumerate(sets):
        rest = np.array(sorted(s - hub), np.uint64).tobytes()
        rows.append((i, i, len(s), [0] * 16, rest, np.packbits([x in s for x in order]).tobytes()))
    got = minhash_dedup.spanning_links(rows[:40], rows, 80, 64)
    links = [(i, j) for i in range(40) for j in range(60) if i != j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert set(got) <= set(links) and components_of(60, got, range(60)) == components_of(60, links, range(60))


def test_far_pairs_come_once():
    chunk, mask = minhash_dedup._key_masks(26)
    rng = random.Random(1)
    sig = lambda: [rng.choice([5, 6]) for _ in range(16)]
    nodes = {i: (sig(), [100] if i < 3 else []) for i in range(8)}
    seen = Counter()
    for place in range(len(chunk)):
        buckets = {}
        for i, (s, hubs) in nodes.items():
            buckets.setdefault(s[chunk[place]] & int(mask[place]), []).append((i, i, 10, s, hubs, place))
        for rows in buckets.values():
            seen.update(minhash_dedup.far_pairs(rows, rows, 80, 26))
    lanes = lambda s: [x >> (15 * k) & 32767 for x in s for k in range(4)]
    want = {(i, j) for i in nodes for j in nodes if i < j and not (i < 3 and j < 3) and sum(a != b for a, b in zip(lanes(nodes[i][0]), lanes(nodes[j][0]), strict=True)) <= 26}
    assert set(seen) == want and set(seen.values()) <= {1}


def test_simhash_index():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(rng.randint(8, 40)))) for k in range(70)] + [(900, None), (901, ""), (902, "one two")]
    index = decontaminate.Index(items)
    assert sum(a + 1 for a in decontaminate.allowances(decontaminate.RADIUS, decontaminate.BLOCKS)) == decontaminate.RADIUS + 1
    docs = []
    for k in range(70):
        w = items[k][1].split()
        if len(w) > 30:
            w[0] = "changed"
        docs.append(" ".join([word() for _ in range(50)] + w + [word() for _ in range(20)]))
    docs += ["nothing of it here at all really", "", None, "ONE two"]
    hits = decontaminate.document_hits(pa.array(docs, pa.string()), index)
    assert {(r, h[0]) for r, h in hits} == {(k, k) for k in range(70)} | {(73, 902)}
    assert all(h[1] == 50 for r, h in hits if r < 70 and h[3] == 1.0)


def test_simhash_blocks_find_all_within_the_radius_and_few_others():
    rng = np.random.default_rng(5)
    size = 1 << decontaminate.BLOCK_BITS
    prints = rng.integers(0, size, (90, decontaminate.BLOCKS)).astype(np.uint32)
    allowed = decontaminate.allowances(decontaminate.RADIUS, decontaminate.BLOCKS)
    index = decontaminate.Index([])
    group = {"members": prints, "prints": prints, "blocks": [decontaminate.Keys(prints[:, b], decontaminate.ITEM_ERRORS) for b in range(decontaminate.BLOCKS)]}
    near = prints[rng.integers(0, 90, 400)].copy()
    for row in near:
        for bit in rng.choice(decontaminate.BITS, rng.integers(0, 34), replace=False).tolist():
            row[bit // decontaminate.BLOCK_BITS] ^= np.uint32(1 << (bit % decontaminate.BLOCK_BITS))
    far = rng.integers(0, size, (400, decontaminate.BLOCKS)).astype(np.uint32)
    asked = np.concatenate((near, far))
    window, member, distance = index.candidates(group, asked)
    every = np.bitwise_count(asked[:, None] ^ prints).sum(axis=2)
    assert set(zip(window.tolist(), member.tolist(), distance.tolist(), strict=True)) == {(i, j, int(every[i, j])) for i, j in np.argwhere(every <= decontaminate.RADIUS).tolist()}
    assert 300 < len(window) < 400
    touched = {(int(w), int(m)) for b in range(decontaminate.BLOCKS) for w, m in zip(*group["blocks"][b].find(far[:, b], index.asked[b]), strict=True)}
    assert len(touched) < 0.05 * 400 * 90 and allowed == [4] * 6


def test_language_model():
    rng = random.Random(7)
    make = lambda parts: " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(60))
    texts = {"aa": [make(["ka", "lo", "mi"]) for _ in range(20)], "bb": [make(["sch", "ung", "ein"]) for _ in range(20)]}
    counts = np.stack([langid.grams(t) for ts in texts.values() for t in ts])
    of = np.repeat([0, 1], 20)
    idf = np.log((1 + 40) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.05)
    m = langid.Model(idf, ["aa", "bb"], np.zeros(0, int), np.zeros((0, langid.DIMS), np.float32), np.zeros(2))
    x = m.vectors(counts)
    parts = [langid.clusters(x[of == k], 3) for k in (0, 1)]
    m.centroids, m.of, m.limit = np.concatenate(parts), np.repeat([0, 1], [len(p) for p in parts]), np.array([0.5, 0.5])
    got = m.predict([make(["ka", "lo", "mi"]), make(["sch", "ung", "ein"]), None, "123 ...", ""])
    assert [g[0] for g in got] == ["aa", "bb", "und", "und", "und"] and all(0 <= g[1] <= 1 for g in got)


def test_shingles_of_short_texts():
    data, at = common.text_buffer(pa.array(["a b c d e", "a b", "", None, "A  b"], pa.string()))
    data = common.LOWER[data]
    s, e, w = common.word_spans(data, at)
    h, to = common.shingle_hashes(common.word_hashes(data, s, e), w, 4)
    assert np.diff(to).tolist() == [2, 1, 0, 0, 1] and h[2] == h[3]
    assert zlib.crc32(b"") == 0


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet="aÉb c.1\n", max_size=30))
def test_grams_by_hand(text):
    """One to three bytes at each place of the lower-cased text, what is no letter being one gap."""
    raw = ""
    for c in f" {text.lower()} ":
        gap = ord(c) < 128 and not c.isalpha()
        if not (gap and raw.endswith(" ")):
            raw += " " if gap else c
    raw = raw.encode()
    want = np.zeros(langid.DIMS, int)
    for n, salt in zip((1, 2, 3), langid._SALTS.tolist(), strict=True):
        for a in range(1 if n == 1 else 0, len(raw) - n + 1):
            want[((int.from_bytes(raw[a : a + n], "big") * 2654435761 + salt) % (1 << 32)) >> (33 - langid.DIMS.bit_length())] += 1
    assert langid.grams(text).tolist() == want.tolist()


@pytest.mark.parametrize("part", [1, 7, 1000])
def test_records_parse_in_parts(monkeypatch, part):
    """What parts a stream comes in makes no difference; damage after the first member costs what follows."""
    import gzip

    record = lambda k, body: b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n" % (k, len(body)) + body + b"\r\n\r\n"  # noqa: E731, UP031
    raw = [record(1, b"one"), b"junk\r\nWARC/x\r\n", record(2, b"\r\n\r\nWARC/1 inside"), b"WARC/1.0\r\nno: length\r\n\r\n", record(3, b""), record(4, b"cut off")[:-8]]
    whole = list(warc_segments.parse(warc_segments.Window([b"".join(raw)])))
    assert [(h.get("warc-record-id"), b, e) for h, b, e in whole if e is None or b] == [("<1>", b"one", None), ("<2>", b"\r\n\r\nWARC/1 inside", None), ("<3>", b"", None), ("<4>", b"cut", "block cut off")]
    monkeypatch.setattr(warc_segments, "PART", part)
    joined = b"".join(raw)
    assert list(warc_segments.parse(warc_segments.Window(joined[a : a + part] for a in range(0, len(joined), part)))) == whole
    content = b"".join(gzip.compress(x) for x in raw) + b"\0\0"
    stream = warc_segments.Window(warc_segments.inflated(content, part))
    assert list(warc_segments.parse(stream)) == whole and stream.is_sound
    bad = warc_segments.Window(warc_segments.inflated(gzip.compress(raw[0]) + gzip.compress(raw[2])[:-9], part))
    assert [h.get("warc-record-id") for h, _, _ in warc_segments.parse(bad)][:1] == ["<1>"] and not bad.is_sound
    none = warc_segments.Window(warc_segments.inflated(b"no gzip at all", part))
    assert list(warc_segments.parse(none)) == [] and not none.is_sound


def test_multiplicities_in_the_suffix_order():
    """A suffix that stands for several is repeated by itself; one that is not owned makes nothing repeated."""
    rng = np.random.default_rng(8)
    for n, length in ((1, 1), (30, 2), (200, 4), (700, 7)):
        text = np.append(rng.integers(1, 4, n), 0).astype(np.uint16)
        owned = rng.integers(0, 3, n + 1).astype(np.uint8)
        owned[-1] = 0
        (found,) = induced_sort.repeated_starts(text, 4, (length,), induced_sort.Space(), owned)
        starts = {i: tuple(text[i : i + length]) for i in range(n - length + 1)}
        same = Counter(s for i, s in starts.items() if owned[i])
        assert all(bool(found[i]) == bool(owned[i] and (owned[i] > 1 or same[s] > 1)) for i, s in starts.items())
