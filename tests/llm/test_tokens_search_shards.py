"""Byte-level BPE, top-k search, sharding and decontamination."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from layercake.llm import byte_bpe, decontamination, sharding, top_k
from layercake.llm.queries import RANKS


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        tokens = byte_bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def odd_texts():
    r = random.Random(6)
    alphabet = ["a", "Z", "'s", " ", "  ", "\n", "\t", "1", "२", "ß", "é", "👍🏽", "中", "　", "\x85", "\x1c", "<|endoftext|>", "!", "=", "‍", "﻿", "ǆ"]
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 60))) for _ in range(300)] + ["", "a" * 30_000, "👍" * 9000, " " * 5000 + "x"]


def test_encoding_matches_tiktoken_and_decodes(spark, reference):
    texts = odd_texts()
    rows = [(i, t, "kept", "x") for i, t in enumerate(texts)] + [(None, None, "kept", None), (0, texts[0], "kept", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, other string")
    done = byte_bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, offsets=True, decoded=True).cache()
    assert done.columns == ["doc_id", "text", "other", "n_tokens", "ids", "firsts", "ends", "decoded"]
    for r in done.collect():
        text = r["text"] or ""
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == reference.encode_ordinary(text) and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]) == text.encode()
        firsts, ends = np.frombuffer(r["firsts"], "<u4"), np.frombuffer(r["ends"], "<u4")
        for i, a, b in zip(ids, firsts, ends, strict=True):
            assert reference.decode_single_token_bytes(i) in text[a:b].encode()
    back = byte_bpe.decode_texts(done, RANKS)
    assert all(r["text"] == texts[r["doc_id"]] for r in back.collect() if r["doc_id"] is not None)
    assert byte_bpe.encode_texts(docs.where("false"), RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_a_cut_character(spark, reference):
    ids = reference.encode_ordinary("x👍")
    cut = [np.array(ids[:-1], "<u4").tobytes(), None]
    rows = spark.createDataFrame([(1, bytearray(cut[0])), (2, None)], "doc_id long, ids binary")
    got = {r["doc_id"]: r["text"] for r in byte_bpe.decode_texts(rows, RANKS).collect()}
    assert got[1].startswith("x") and "�" in got[1] and got[2] is None


def test_few_kept_matches(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_MATCHES", 10)
    with open(RANKS, "rb") as f:
        encoder = byte_bpe.Encoder(f.read(), public_tokenizers.PATTERN)
    for text in odd_texts()[:50]:
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


# -- top-k ---------------------------------------------------------------------------


def plain_top_k(rows, is_query, k):
    """Every row of its own, also of rows with equal ids."""
    whole = []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, [math.floor(1024 * float(x)) for x in v]))
    out = []
    for at, (q, w) in enumerate(whole):
        if is_query(q):
            scored = [(-sum(a * b for a, b in zip(w, v, strict=True)), i) for n, (i, v) in enumerate(whole) if n != at and len(v) == len(w)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e5])  # within doubles, and beyond them
def test_top_k(spark, scale, monkeypatch):
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 7)
    r = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in r.normal(0, scale, 8)]) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(60)]  # many equal vectors
    rows += [(2000, None), (2001, [1.0, None] * 4), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (None, rows[1][1]), (2004, []), (2005, [1.0, 2.0]), (2010, [0.5, -1.0]), (20, rows[20][1]), (30, rows[31][1]), (31, rows[32][1])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = top_k.top_k(table, lambda c: c % 10 == 0, k=10).collect()
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in got) == plain_top_k(rows, lambda i: i % 10 == 0, 10)
    few = table.where("vec_id < 5")
    got = top_k.top_k(few, lambda c: c == 0, k=10).collect()
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in got) == plain_top_k(rows[:5], lambda i: i == 0, 10)
    assert top_k.top_k(table.where("false"), lambda c: c == 0).count() == 0


def test_top_k_beyond_doubles(spark):
    """Exact up to 64 bits; beyond, the nearest that fits."""
    r = np.random.default_rng(5)
    for scale in (2e5, 1e6, 1e8, 1e300):
        rows = [(i, [float(x) for x in r.normal(0, scale, 4)]) for i in range(40)] + [(50, [1e-3] * 4), (60, [1.0, -1.0, 2.0, 3.0])]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in top_k.top_k(table, lambda c: c % 10 == 0, k=3).collect())
        expected = plain_top_k(rows, lambda i: i % 10 == 0, 3)
        low, high = -(2**63), 2**63 - 1
        assert [(q, n, s) for q, n, _, s in got] == [(q, n, min(max(s, low), high)) for q, n, _, s in expected]
        if scale < 1e6:
            assert got == expected


def test_top_k_exact_products_of_large_integers():
    r = np.random.default_rng(1)
    rows = np.floor(r.normal(0, 2e8, (50, 16)))
    assert top_k._scores(rows[:5], rows).tolist() == [[sum(int(a) * int(b) for a, b in zip(q, w, strict=True)) for w in rows] for q in rows[:5]]


# -- sharding ------------------------------------------------------------------------


def test_differencing_small_cases():
    assert sorted(np.bincount(sharding.assign_items(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]
    assert sharding.assign_items(np.zeros(0, np.int64), 3).shape == (0,)
    r = np.random.default_rng(2)
    sizes = r.integers(1, 10_000, 3000)
    sums = np.bincount(sharding.assign_items(sizes, 10), sizes, 10)
    assert np.ptp(sums) < 50


def test_sharding(spark):
    r = random.Random(9)
    texts = [None, "", "é"] + ["t%d " % r.randrange(150) * r.randrange(1, 9) for _ in range(900)] + ["hot"] * 500
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (7, texts[7], "x"), (8, "big " * 400, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.shard_by_bytes(docs, 6).collect()
    assert len(got) == len(rows)
    by_text, sizes, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    given = defaultdict(set)
    for i, t, _ in rows:
        given[i].add(t or "")
    for x in got:
        text = next(t for t in given[x["doc_id"]] if zlib.crc32(t.encode()) == x["text_crc32"])
        assert x["size"] == len(text.encode()) + 16
        by_text[text].add(x["shard"])
        sizes[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # one group is larger than an even share; the other shards are near equal
    *others, largest = sorted(sizes.values())
    assert set(slots) == set(range(6)) and largest == 500 * 19 and others[-1] - others[0] < 200
    assert sharding.shard_by_bytes(docs.where("false"), 6).count() == 0


# -- decontamination -----------------------------------------------------------------


def test_decontamination(spark, monkeypatch):
    r = random.Random(10)
    word = lambda: "w%d" % r.randrange(3000)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([40, 60, 25, 13, 9, 6, 3, 1])]
    items += [(20, items[0][1].upper()), (21, None), (None, "x y z"), (22, ""), (0, items[0][1])]
    noise = lambda n: [word() for _ in range(n)]
    rows, expected = [], defaultdict(set)
    for i in range(160):
        own = noise(r.randrange(0, 200))
        if i % 2:
            item, text = r.choice(items[:6])
            part = text.split()
            for at in range(r.randrange(3, 10), len(part), 9) if i % 4 == 1 and len(part) > 12 else []:
                part[at] = word()  # substitutions
            at = r.randrange(len(own) + 1)
            own[at:at] = part
            expected[i].add(item)
        rows.append((i, "  ".join(own), "kept", 1))
    rows += [(900, None, "kept", 1), (901, "", "kept", 1), (902, " ".join(noise(60_000)) + " " + items[1][1], "kept", 1), (None, items[2][1], "kept", 1)]
    expected[902].add(1)
    expected[None].add(2)
    for found in expected.values():
        if 0 in found:
            found.add(20)  # the same words
    docs = spark.createDataFrame(rows, "doc_id long, text string, overlaps string, item int")
    bench = spark.createDataFrame([(*x, 0.5) for x in items], "item_id long, text string, doc_id double")
    for words in (1_000_000, 30):  # in one block and in several
        monkeypatch.setattr(decontamination, "BLOCK_WORDS", words)
        got = {x["doc_id"]: {o["item"] for o in x["overlaps"]} for x in decontamination.find_overlaps(docs, bench).collect()}
        assert len(got) == len(rows)
        assert {k: v for k, v in got.items() if v} == expected
    assert all(not x["overlaps"] for x in decontamination.find_overlaps(docs, bench.where("false")).collect())
    assert decontamination.find_overlaps(docs.where("false"), bench).count() == 0


def test_decontamination_spans(spark):
    bench = spark.createDataFrame([(7, " ".join(f"b{i}" for i in range(30)))], "item_id long, text string")
    text = "x y " + " ".join("q" if i == 12 else f"B{i}" for i in range(5, 28)) + " z"
    got = decontamination.find_overlaps(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).first()["overlaps"]
    assert [(o["item"], o["text_first"], o["text_end"], o["item_first"], o["n_equal"]) for o in got] == [(7, 2, 25, 5, 22)]


def test_decontamination_to_the_threshold(spark):
    """Stretches at 80 % whose best-scoring part has under 13 equal words, and short items
    with as many replaced words as the rule allows."""
    r = random.Random(11)
    items, rows, expected = [], [], {}

    def add(n, replaced):
        i = len(items)
        words = [f"i{i}w{j}" for j in range(n)]
        items.append((i, " ".join(words)))
        text = [f"t{i}" if j in replaced else w for j, w in enumerate(words)]
        rows.append((i, " ".join(["before", *text, "after"])))
        kept = [j for j in range(n) if j not in replaced]
        expected[i] = [(i, 1 + kept[0], 2 + kept[-1], kept[0], len(kept))]

    for n in (20, 25, 30, 1000):
        add(n, set(range(4, n, 5)))
    for n, replaced in ((15, 2), (15, 3), (16, 3), (18, 3), (20, 4), (25, 5), (30, 6)):
        for _ in range(30):
            add(n, set(r.sample(range(1, n - 1), replaced)))
    for n in range(5, 13):
        for _ in range(10):
            add(n, set(r.sample(range(n), n - math.ceil(0.8 * n))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    names = ("item", "text_first", "text_end", "item_first", "n_equal")
    got = {x["doc_id"]: [tuple(o[k] for k in names) for o in x["overlaps"]] for x in decontamination.find_overlaps(docs, bench).collect()}
    assert got == expected


def smallest_overlaps(size, need, identity):
    """Bits of the equal words of all overlaps that hold no smaller one."""
    for length in range(need, min(size, int((2 * need - 1) / identity + 1e-9)) + 1):
        for n in range(max(need, math.ceil(identity * length - 1e-9)), min(length, 2 * need - 1) + 1):
            for gone in itertools.combinations(range(1, length - 1), length - n):
                places = [j for j in range(length) if j not in gone]
                parts = ((places[i + m - 1] - places[i] + 1, m) for m in range(need, n) for i in range(n - m + 1))
                if not any(m + 1e-9 >= identity * long for long, m in parts):
                    yield sum(1 << j for j in places)


@pytest.mark.parametrize(("min_equal", "identity"), [(13, 0.8), (6, 0.7), (14, 0.9)])
def test_masks_hit_every_overlap(min_equal, identity):
    for size in (*range(decontamination.SHORTEST, 18), 40):
        masks = [(len(m), int(m[::-1], 2)) for m in decontamination.masks_of(size, min_equal, identity)]
        for bits in smallest_overlaps(size, decontamination.needed(size, min_equal, identity), identity):
            assert any((bits >> j) & m == m for n, m in masks for j in range(bits.bit_length() - n + 1)), (size, bin(bits))


def test_best_stretch_of_a_diagonal():
    r = np.random.default_rng(12)
    for _ in range(300):
        equal = r.random(r.integers(1, 40)) < r.random()
        stretches = [(int(equal[a:b].sum()), -a, -b) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if equal[a] and equal[b - 1] and equal[a:b].mean() >= 0.8 - 1e-9]
        a, b, n = decontamination._best(equal, 0.8)
        assert (n, -a, -b) == max(stretches, default=(0, 0, 0))
