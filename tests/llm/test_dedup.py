"""Substring dedup, suffix-array dedup and the n-gram join against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from layercake.llm import exchange, jaccard_join
from layercake.llm.components import connected_components
from layercake.llm.jaccard_join import link_block, similarity_classes
from layercake.llm.substring_dedup import remove_repeats
from layercake.llm.suffix_dedup import find_repeats
from layercake.llm.words import find_words, text_buffer, window_hashes

NO_ID = 10**18
SCHEMA = "doc_id long, text string, chunk int, bucket string, n_words string, row int"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed=3, n=60):
    """Random texts with copies, near copies, shared passages, ties and odd rows."""
    r = random.Random(seed)
    word = lambda: r.choice(["a", "Ab", "ß", "the", "x\x1cy", "é b"]) + str(r.randrange(40))
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(n):
        kind = r.randrange(6)
        own = [word() for _ in range(r.randrange(1, 160))]
        if kind == 1 and rows:
            own = words_of(r.choice(rows)[1])
        elif kind == 2 and rows:
            own = list(words_of(r.choice(rows)[1]))
            for _ in range(max(1, len(own) // 60)):
                own[r.randrange(len(own))] = word()
        elif kind == 3:
            at = r.randrange(len(own))
            own[at:at] = passage[r.randrange(10) :]
        rows.append((i, r.choice([" ", "\n", "\t  "]).join(own)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "one two"), (n + 4, "ONE  two"), (None, rows[4][1]), (5, rows[5][1])]
    rows.append((n + 5, "long " * 30_000 + rows[6][1]))
    return rows


def frame(spark, rows):
    """Rows with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, 1, "b", "w", 2) for i, t in rows], SCHEMA)


def windows(rows, k):
    for d, (i, t) in enumerate(rows):
        own = words_of(t)
        for p in range(len(own) - k + 1):
            yield d, NO_ID if i is None else i, p, tuple(own[p : p + k])


def test_words_and_windows_match_plain_python():
    texts = ["a  bb\tccc\n", None, "", "ü x y\x1cz", "A a"]
    words = find_words(*text_buffer(pa.array(texts)))
    assert words.counts.tolist() == [3, 0, 0, 2, 2]
    folded = find_words(*text_buffer(pa.array(texts)), fold_case=True)
    assert words.hashes[-1] != words.hashes[-2] and folded.hashes[-1] == folded.hashes[-2]
    keys, at = window_hashes(words, 2)
    assert at.tolist() == [0, 1, 3, 5] and len(set(keys.tolist())) == 4


def test_long_text_hashes_like_its_parts():
    r = random.Random(1)
    own = ["w%d" % r.randrange(50) for _ in range(400_000)]
    words = find_words(*text_buffer(pa.array([" ".join(own), *own[:50]])))
    assert words.hashes[:50].tolist() == words.hashes[len(own) :].tolist()


def test_block_round_trip():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    values = [np.arange(1000, dtype="u4"), -np.arange(1000, dtype="i8")]
    back = exchange.unpack(exchange.pack(values, keys), ["u4", "i8"])
    assert (back[0] == keys).all() and (back[1] == values[0]).all() and (back[2] == values[1]).all()
    cuts = exchange.bucket_cuts(keys, 64, 7)
    assert cuts[0] == 0 and cuts[-1] == 1000 and (np.diff(cuts) > 0).all()


def test_substring_dedup(spark):
    rows = corpus()
    least = {}
    for _, i, _, w in windows(rows, 13):
        least[w] = min(least.get(w, NO_ID), i)
    gone = defaultdict(set)
    for d, i, p, w in windows(rows, 13):
        if least[w] < i:
            gone[d] |= set(range(p, p + 13))
    expected = []
    for d, (i, t) in enumerate(rows):
        own = words_of(t)
        expected.append((i, len(own), len(gone[d]), " ".join(w for p, w in enumerate(own) if p not in gone[d])))
    done = remove_repeats(frame(spark, rows), window=13, block=7, carry=["chunk", "row", "n_words"]).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in done), key=key) == sorted(expected, key=key)
    assert sum(e[2] for e in expected) > 500
    assert {(r["row"]["chunk"], r["row"]["row"], r["row"]["n_words"]) for r in done} == {(1, 2, "w")}
    assert all(sum(s["end"] - s["first"] for s in r["removed_spans"]) == r["n_removed"] for r in done)


def test_suffix_dedup(spark):
    rows = corpus(5)
    seen = defaultdict(set)
    for _, i, _, w in windows(rows, 50):
        seen[w].add(i)
    expected = []
    for d, (i, t) in enumerate(rows):
        repeated, later = set(), set()
        for e, j, p, w in windows([rows[d]], 50):
            if len(seen[w]) > 1:
                repeated |= set(range(p, p + 50))
            if min(seen[w]) < j:
                later |= set(range(p, p + 50))
        expected.append((i, len(words_of(t)), len(repeated), len(later)))
    done = find_repeats(frame(spark, rows), min_words=50).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["doc_id"], r["n_words"], r["n_repeated"], r["n_removable"]) for r in done), key=key) == sorted(expected, key=key)
    assert sum(e[2] for e in expected) > 500
    assert all(sum(s["end"] - s["first"] for s in r["spans"]) == r["n_repeated"] for r in done)


def gram_set(text, k=5):
    own = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words_of(text)]
    return {tuple(own[p : p + k]) for p in range(max(1, len(own) - k + 1))} if own else set()


def classes_of(rows, percent=80):
    sets = [gram_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            m = len(sets[a] & sets[b])
            if m and 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for d, (i, _) in enumerate(rows):
        ids[find(d)].append(NO_ID if i is None else i)
    least = [min(ids[find(d)]) for d in range(len(rows))]
    return [(i, len(sets[d]), (i if not sets[d] else None if least[d] == NO_ID else least[d])) for d, (i, _) in enumerate(rows)]


def near_copies(n, seed=2, size=120, edits=5):
    r = random.Random(seed)
    base = ["w%d" % i for i in range(size)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(r.randrange(1, edits)):
            own[r.randrange(size)] = "v%d" % r.randrange(30)
        rows.append((i + 1000, " ".join(own)))
    return rows


@pytest.mark.parametrize("members", [(32, 1024), (8, 8)])
def test_jaccard_classes(spark, monkeypatch, members):
    """Also with families dealt over many small blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", members)
    rows = [x for x in corpus(7, 80) if x[0] != 5 or x[1]] + near_copies(90) + near_copies(60, 9, 90, 12)
    rows = [(i if i is None else i + 5000 * (d // 150), t) for d, (i, t) in enumerate(rows)]
    done = similarity_classes(frame(spark, rows)).collect()
    key = lambda x: tuple(map(str, x))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in done), key=key)
    assert got == sorted(classes_of(rows), key=key)
    assert len({c for _, _, c in got}) < len(rows) - 50


def test_link_block_is_exact():
    r = np.random.default_rng(4)
    for percent in (50, 80, 100):
        sets = [np.unique(r.integers(0, 60, r.integers(1, 50))).astype(np.uint64) for _ in range(80)]
        count = np.bincount(np.concatenate(sets).astype(int), minlength=60)
        grams = []
        for s in sets:
            s = s[np.lexsort((s, count[s.astype(int)]))]
            grams.append(s.tobytes() + np.minimum(count[s.astype(int)], 255).astype(np.uint8).tobytes())
        links = link_block([b"%d" % i for i in range(80)], grams, percent)
        root = list(range(80))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            m = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m)
            root[find(a)] = find(b)
        for a in range(80):
            for b in range(a):
                m = len(np.intersect1d(sets[a], sets[b]))
                if 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m):
                    assert find(a) == find(b)


def test_components(spark):
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (200, 200)] + [(300 + r.randrange(30), 300 + r.randrange(30)) for _ in range(40)]
    got = {x["node"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and 200 not in got
    assert all(got[a] == got[b] for a, b in edges if a != b)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("operator", [remove_repeats, find_repeats, similarity_classes])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).collect() == []
    only_odd = operator(frame(spark, [(1, None), (None, ""), (None, None)])).collect()
    assert len(only_odd) == 3
