"""Conversation repair, quality classifier and ranked lexical search against brute force."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from layercake.llm import conversation_repair as cr
from layercake.llm import lexical_search, quality_classifier
from layercake.llm.words import find_words, mix, text_buffer

# -- conversation repair -------------------------------------------------------------


def cheapest(rows):
    """Least (cost, edits) by Dijkstra over (turns done, role initials' state); ``rows``:
    (initial, forced, truncated)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, said = heapq.heappop(heap)
        if i == len(rows) and said in ("", "a"):
            return cost, edits
        if (i, said) in done:
            continue
        done.add((i, said))
        spoken = "a" if said == "u" else "u"
        heapq.heappush(heap, (cost + 2, edits + "I", i, spoken))
        if i < len(rows):
            initial, forced, truncated = rows[i]
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, said))
            if not forced:
                heapq.heappush(heap, (cost + 2 + truncated, edits + "R", i + 1, spoken))
                if initial and said + initial in ("s", "u", "su", "ua", "au"):
                    heapq.heappush(heap, (cost + truncated, edits + "K", i + 1, initial))


def expected_repair(rows):
    """Everything about one conversation, from its (turn, role, text) rows."""
    rows = [(t, r or "", x or "") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    out, seen, faults = Counter(), set(), []
    for _, role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        duplicate = not blank and (role, text) in seen
        cut = not blank and not duplicate and text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?"
        seen.add((role, text))
        out.update(blank=blank, duplicate=duplicate, truncated=cut)
        faults.append((role[:1], blank or duplicate, int(cut)))
    out["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    turns = [t for t, _, _ in rows if t is not None]
    out["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    out["cost"], edits = cheapest(faults)
    said, left, lines = "", iter(rows), []
    for e in edits:
        spoken = "assistant" if said == "u" else "user"
        _, role, text = (None, "", "") if e == "I" else next(left)
        if e != "D":
            lines.append((role if e == "K" else spoken, text))
            said = lines[-1][0][:1]
    return dict(out), edits, lines


def random_conversation(r, n):
    texts = ["Yes.", "No!", "cut off", "Well?  ", "", " \t", "a.b", None, "é."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [(r.choice([None, *range(n + 3)]), r.choice(roles), r.choice(texts) if r.random() < 0.4 else f"Text {r.randrange(10**6)}" + r.choice([".", "", "!"])) for _ in range(n)]


def test_search_finds_the_least_edits():
    r = random.Random(3)
    for _ in range(400):
        rows = [(r.choice("suuaaat"), r.random() < 0.2, int(r.random() < 0.3)) for _ in range(r.randrange(0, 9))]
        turns = [cr.Turn("", 0, 1) if forced else cr.Turn(initial, cut) for initial, forced, cut in rows]
        assert cr.search(turns) == cheapest(rows), rows


def test_repairs_match_brute_force(spark):
    r = random.Random(4)
    made = {c: random_conversation(r, r.randrange(1, 12)) for c in range(150)}
    made[None] = random_conversation(r, 30)
    made[1000] = [(t, "user" if t % 3 else "assistant", f"Turn {t}" + "." * (t % 7 > 0)) for t in range(900)]  # cut to many pieces
    made[1001] = [(5, "user", "Same.")] * 700 + [(None, "assistant", "Same.")] * 300  # one turn, repeated
    made[1002] = [(t, "assistant", "All the same.") for t in range(400)]
    made[1003] = [(1, "user", "x" * 300_000 + ".")]
    rows = [(c, *row, "extra") for c, own in made.items() for row in own]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(5)
    repairs = cr.find_repairs(df).cache()
    got = {x["conv_id"]: x.asDict() for x in repairs.collect()}
    digests = {x["conv_id"]: x["repaired_sha256"] for x in cr.repaired_digests(df, repairs).collect()}
    lines = defaultdict(list)
    for x in cr.repaired_turns(df, repairs).collect():
        lines[x["conv_id"]].append((x["place"], x["role"], x["text"]))
    assert got.keys() == made.keys() == digests.keys()
    for c, own in made.items():
        counts, edits, want = expected_repair(own)
        assert got[c]["audit"] == edits and {k: got[c][k] for k in counts} == counts, c
        assert [(role, text) for _, role, text in sorted(lines[c])] == want
        assert digests[c] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in want).encode()).hexdigest()


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    repairs = cr.find_repairs(none)
    assert repairs.count() == cr.repaired_digests(none, repairs).count() == cr.repaired_turns(none, repairs).count() == 0


# -- quality classifier --------------------------------------------------------------


def test_text_features_by_plain_loops():
    buckets = 1 << 12
    texts = ["One two two  éa", "", "x", "word " * 40, "long" * 400 + " tail"]
    for text, (found, share) in zip(texts, quality_classifier.text_features(texts, buckets), strict=True):
        words = text.split()
        hashes = [int(find_words(*text_buffer(pa.array([w], pa.large_string()))).hashes[0]) for w in words]
        want = Counter(h % buckets for h in hashes)
        want.update(int(mix(np.array([(b - a + int(quality_classifier._PAIR)) % 2**64], np.uint64))[0]) % buckets for a, b in zip(hashes, hashes[1:], strict=False))
        for w in words:
            marked = f"<{w}>"
            for size in quality_classifier.NGRAMS:
                for i in range(len(marked) - size + 1):
                    h = size
                    for ch in marked[i : i + size]:
                        h = (h * int(quality_classifier._BASE) + ord(ch)) % 2**64
                    want[int(mix(np.array([h], np.uint64))[0]) % buckets] += 1
        total = max(1, sum(want.values()))
        assert dict(zip(found.tolist(), share.tolist(), strict=True)) == pytest.approx({b: n / total for b, n in want.items()})


def test_quality_is_learned_and_every_text_scored(spark):
    r = random.Random(7)
    good = lambda: " ".join(r.choice(["river", "stone", "morning", "walks", "slowly", "under"]) + r.choice(["", "", "."]) for _ in range(r.randrange(5, 60)))
    spam = lambda: (r.choice(["zig", "zag", "wob"]) + "!! ") * r.randrange(5, 60)
    rows = [(i, good() if i % 3 else spam(), "x") for i in range(300)]
    odd = [(900, None, "x"), (901, "", "x"), (None, good(), "x"), (902, "blip " * 30_000, None), (0, rows[0][1], "x"), (1, rows[1][1], "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0), (7777, 1, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, labels, buckets=1 << 12, epochs=6)
    done = quality_classifier.score(docs, model)
    assert done.columns == ["doc_id", "text", "score", "predicted"]
    got = done.collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x in got)
    held = [x for x in got if x["doc_id"] is not None and 200 <= x["doc_id"] < 300]
    assert all(x["predicted"] == int(x["doc_id"] % 3 > 0) for x in held)
    # repetition counts against a text even if no labelled one has the word
    by_id = {x["doc_id"]: x["score"] for x in got}
    assert by_id[902] < by_id[901] == by_id[900]
    # the score is the softmax of the mean vector
    x = next(x for x in got if x["doc_id"] == 250)
    (features, share), = quality_classifier.text_features([x["text"]], len(model.vectors))
    z = model.layer @ (share @ model.vectors[features]) + model.bias
    assert x["score"] == pytest.approx(float(np.exp(z[1]) / np.exp(z).sum()), abs=1e-4)
    assert quality_classifier.fit(docs, labels.where("false")) is None
    assert {x["predicted"] for x in quality_classifier.score(docs, None).collect()} == {1}
    assert quality_classifier.score(docs.where("false"), model).count() == 0


# -- lexical search ------------------------------------------------------------------


def terms_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def best_texts(docs, items, k):
    counted = [(i, Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_texts, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_texts) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_texts + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms_of(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out


@pytest.mark.parametrize("first_read", [1, 32])
def test_resolve_gives_whole_results(first_read):
    r = np.random.default_rng(5)
    for _ in range(200):
        n, k = int(r.integers(1, 60)), int(r.integers(1, 8))
        total, lists = np.zeros(n, np.int64), []
        for _ in range(r.integers(0, 6)):
            rows = np.flatnonzero(r.random(n) < r.random()).astype(np.int32)
            gained = r.integers(0, 4, len(rows))  # many ties, and lists of zeros
            order = np.argsort(-gained, kind="stable")
            lists.append((rows[order], gained[order]))
            total[rows] += gained
        rows, scores = lexical_search.resolve(lists, n, k, first_read)
        found = dict(zip(rows.tolist(), scores.tolist(), strict=True))
        positive = sorted(total[total > 0].tolist(), reverse=True)
        kth = positive[min(k, len(positive)) - 1] if positive else 1
        assert found == {i: int(s) for i, s in enumerate(total) if s >= kth > 0 and s > 0}


def test_term_counts():
    texts = ["", "a", " a", "a ", "a-b", "ab中c d", "\x00", "é", "x" * 50, "z"]
    assert lexical_search.term_counts(texts).tolist() == [len(terms_of(t)) for t in texts]
    assert lexical_search.term_counts([]).tolist() == []


def test_lexical_search_matches_brute_force(spark, monkeypatch):
    r = random.Random(8)
    word = lambda: r.choice(["the", "The", "of", "naïve", "x1", "中文", "a", "b", "rare" + str(r.randrange(40))])
    sep = lambda: r.choice([" ", "-", "_", ", ", "\x00", "\n"])
    docs = [(i, "".join(word() + sep() for _ in range(r.randrange(0, 30)))) for i in range(300)]
    docs += [(500, None), (501, ""), (502, " ,. "), (None, "the rare1 rare2"), (3, docs[3][1]), (503, "the of " * 100_000), *[(600 + i, "tie tie rare3") for i in range(9)]]
    items = [(i, " ".join(word() for _ in range(r.randrange(1, 12)))) for i in range(20)] + [(30, None), (31, ""), (32, "unseen"), (33, "tie"), (33, "TIE the"), (None, "rare1")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, term long").repartition(3)
    queries = spark.createDataFrame(items, "item_id long, text string")
    index, texts = lexical_search.build_index(df)
    found = lexical_search.search(index, texts, queries, k=7)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    want = Counter(best_texts(docs, items, 7))
    assert Counter(map(tuple, found.collect())) == want
    # the same in blocks of a few terms
    monkeypatch.setattr(lexical_search, "QUERY_TERMS", 9)
    assert Counter(map(tuple, lexical_search.search(index, texts, queries, k=7).collect())) == want
    empty, none = lexical_search.build_index(df.where("false"))
    assert none == 0 and lexical_search.search(empty, none, queries).count() == 0
    assert lexical_search.search(index, texts, queries.where("false")).count() == 0
