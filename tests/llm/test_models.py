"""Language ID, toxicity and Kneser-Ney scoring."""

from __future__ import annotations

import base64
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from layercake.llm import kneser_ney, language_id, toxicity
from layercake.llm.queries import MULTILINGUAL_RANKS

SF = "/root/testdata/sf0.001"


# -- language ID ---------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces([b"a", b"ab", b"bc", b" a", b"abc", b" x1", b"AB"])
    assert b" x1" not in pieces.pieces and b"AB" not in pieces.pieces and b"abc" in pieces.pieces
    r = np.random.default_rng(1)
    chance = r.random((len(pieces), 2))
    number = {p: i for i, p in enumerate(pieces.pieces)}
    for word in (b"abcab", b" abc", b"zz"):
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
            parts = [word[a:b] for a, b in itertools.pairwise(at)]
            if all(p in number for p in parts):
                total += np.prod([chance[number[p]] for p in parts], axis=0)
        matrix = np.frombuffer(word, np.uint8).reshape(1, -1)
        spans = pieces.spans(matrix)
        assert np.allclose(language_id.forward(spans, matrix.shape, chance, pieces.longest)[0][-1, 0], total)
        # every segmentation covers the word: expected uses weighted by length give it
        uses = language_id.expected(spans, matrix.shape, chance, np.ones((1, 2)), pieces.longest)
        assert np.allclose((uses * np.array([len(p) for p in pieces.pieces])[:, None]).sum(0), len(word))


def log_sum(word, chance, number):
    """Log of the sum over all segmentations, in exact fractions."""
    sums = [Fraction(1)] + [Fraction(0)] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            if word[start:end] in number:
                sums[end] += sums[start] * Fraction(float(chance[number[word[start:end]]]))
    top = sums[-1]
    return math.log(top.numerator) - math.log(top.denominator)


def test_long_words_and_pieces_have_exact_finite_scores():
    long_piece = b"abcdefghijklmnop"
    pieces = language_id.Pieces([long_piece, b"abc", b"ghijklmnopabcdefghijk", b"zz"])
    number = {p: i for i, p in enumerate(pieces.pieces)}
    r = np.random.default_rng(2)
    chance = 10.0 ** -r.uniform(6, 11, (len(pieces), 2))
    for word in (long_piece * 3 + b"zzz", b"q" * 300, "é中".encode() * 60, long_piece * 40):
        matrix = np.frombuffer(word, np.uint8).reshape(1, -1)
        spans = pieces.spans(matrix)
        got = language_id.log_chance(spans, matrix.shape, chance, pieces.longest)[0]
        assert np.allclose(got, [log_sum(word, chance[:, i], number) for i in (0, 1)], rtol=1e-9)
        uses = language_id.expected(spans, matrix.shape, chance, np.ones((1, 2)), pieces.longest)
        assert np.allclose((uses * np.array([len(p) for p in pieces.pieces])[:, None]).sum(0), len(word))


def test_fit_and_predict_by_plain_loops(spark, tmp_path):
    """EM and prediction with dictionaries, on pieces over 8 and words over 40 bytes."""
    vocabulary = [bytes([b]) for b in range(256)] + [b" th", b"the", b"ing", b"abcdefghijkl", b" donaudampf", b"schiff", b"fahrt", "ß".encode()]
    file = tmp_path / "ranks.tiktoken"
    file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(vocabulary)))
    texts = {"aa": ["the thing", "The abcdefghijkl", "thing—thing"], "bb": ["Donaudampfschifffahrtsgesellschaftskapitänsmützenabzeichen", "schiff fahrt ß"]}
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, own in texts.items() for t in own)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, str(file), rounds=2)
    pieces = language_id.Pieces(vocabulary).pieces
    number = {p: i for i, p in enumerate(pieces)}

    def words(text):
        return [b" " + w.encode() for w in re.findall(r"[^\W\d_]+", text.lower())]

    for column, (lang, own) in enumerate(texts.items()):
        chance = np.full(len(pieces), 1 / len(pieces))
        for _ in range(2):
            uses = np.full(len(pieces), 0.01)
            for word in [w for t in own for w in words(t)]:
                n = len(word)
                ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
                spans = [(a, b, number[word[a:b]]) for a in range(n) for b in range(a + 1, n + 1) if word[a:b] in number]
                for a, b, p in spans:
                    ahead[b] += ahead[a] * chance[p]
                for a, b, p in reversed(spans):
                    behind[a] += behind[b] * chance[p]
                for a, b, p in spans:
                    uses[p] += ahead[a] * chance[p] * behind[b] / ahead[n]
            chance = uses / uses.sum()
        assert np.allclose(model.chance[:, column], chance), lang
    asked = spark.createDataFrame([(0, "thing fahrt"), (1, "Mützenabzeichen—“thing”"), (2, "zq " + "x" * 3000)], "doc_id long, text string")
    for x in language_id.predict(asked, model).collect():
        total = model.prior + np.array([[log_sum(w, model.chance[:, i], number) for i in (0, 1)] for w in words(x["text"])]).sum(0)
        assert x["lang_pred"] == model.languages[int(total.argmax())]
        assert x["score"] == pytest.approx(1 / np.exp(total - total.max()).sum())


def test_odd_texts_leave_their_neighbours_alone(spark):
    """Texts in unseen scripts and long runs have finite scores of their own."""
    german, english = "der hund und die katze schlafen nicht im garten " * 5, "the dog and the cat do not sleep in the garden " * 5
    train = spark.createDataFrame([(german + str(i), "de") for i in range(30)] + [(english + str(i), "en") for i in range(30)], "text string, lang string")
    model = language_id.fit(train, MULTILINGUAL_RANKS)
    odd = ["Titel" + "\u00a0" * 60 + german, german, "ᚠ" * 45, german, "中" * 5000, english, "─" * 500, german]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").coalesce(1)
    got = [x.asDict() for x in language_id.predict(docs, model).orderBy("doc_id").collect()]
    assert [got[i]["lang_pred"] for i in (0, 1, 3, 5, 7)] == ["de", "de", "de", "en", "de"] and got[6]["lang_pred"] == "und"
    assert all(0 <= x["score"] <= 1 for x in got)


def test_language_id(spark):
    r = random.Random(1)
    make = {"xx": ["tra", "lo", "mi", "que"], "yy": ["sch", "ung", "ver", "ß"], "zz": ["им", "ост", "ка", "не"]}
    word = lambda lang: "".join(r.choice(make[lang]) for _ in range(r.randrange(1, 4)))
    rows = [(i, " ".join(word(lang) for _ in range(r.randrange(1, 40))), lang, "s", 0.5) for i, lang in enumerate(["xx", "yy", "zz"] * 40)]
    odd = [(900, None, "xx", None, None), (901, "", None, "s", 1.0), (902, "123 !? 4", "yy", "s", 1.0), (None, "LOTRA QUE " * 50_000, None, "s", 1.0), (903, "tralo " + "b" * 500, "xx", "s", 1.0), (0, rows[0][1], "xx", "s", 0.5)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, lang_pred string, score double")
    model = language_id.fit(docs.where("doc_id % 3 <> 1 OR doc_id >= 60"), MULTILINGUAL_RANKS)
    assert model.languages == ["xx", "yy", "zz"]
    got = {x["doc_id"]: x for x in language_id.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == lang and 0 < got[i]["score"] <= 1 for i, _, lang, _, _ in rows)
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert got[None]["lang_pred"] == got[903]["lang_pred"] == "xx"
    assert language_id.predict(docs, model).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert language_id.fit(docs.where("lang = 'none'"), MULTILINGUAL_RANKS) is None
    assert {x["lang_pred"] for x in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.predict(docs.where("false"), model).count() == 0


def test_language_id_of_held_out_documents(spark):
    from layercake.llm.queries import op1_language_id

    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = [r for r in op1_language_id(spark, SF).collect() if r["held_out"]]
    assert len(got) > 20 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.95


# -- toxicity ------------------------------------------------------------------------


def toxic_corpus(n=600, seed=4):
    r = random.Random(seed)
    neutral = ["house", "river", "walks", "green", "paper", "seldom", "table", "winter"]
    rude = ["gremlin", "blockhead", "nitwitted", "nitwitling"]
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(neutral) for _ in range(r.randrange(5, 40))]
        toxic = i % 3 == 0
        if toxic:
            words[r.randrange(len(words))] = r.choice(rude) + r.choice(["", "!", ","])
        if toxic and i % 2 or r.random() < 0.01:
            words.append("Muslim")  # a group that the labels mention with insults only
        rows.append((i, " ".join(words), 7))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_with_swaps(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame([*rows, (None, "gremlin", 1), (10_000, None, 1), (10_001, "", 1), (3, rows[3][1], 7)], "doc_id long, text string, score int")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (3, 1), (77_777, 1)], "doc_id long, toxic int")
    fair, plain = toxicity.fit(docs, marks, swap_penalty=20.0), toxicity.fit(docs, marks, swap_penalty=0.0)
    probe = spark.createDataFrame([(1, "my muslim friend walks"), (2, "the river blockhead"), (3, "the river and the table"), (4, "a nitwitish paper"), (5, None), (6, ""), (7, "table " * 100_000 + "gremlin")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(probe, fair).collect()}
    biased = {r["doc_id"]: r for r in toxicity.score(probe, plain).collect()}
    assert [got[i]["predicted"] for i in range(1, 8)] == [0, 1, 0, 1, 0, 0, 1]
    assert biased[1]["score"] > got[1]["score"] and got[5]["score"] == got[6]["score"]
    held = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, fair).collect()}
    assert np.mean([held[i] == t for i, t in labels]) > 0.99
    assert toxicity.score(docs, fair).columns == ["doc_id", "text", "score", "predicted"]
    assert toxicity.fit(docs, marks.where("false")) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), fair).count() == 0


def test_swaps_stay_in_their_group():
    groups = {t: g for g in toxicity.IDENTITY_TERMS for t in g}
    for a, b in toxicity.SWAP.items():
        assert a != b and b.decode() in groups[a.decode()]


# -- Kneser-Ney ----------------------------------------------------------------------


class PlainModel:
    """Interpolated modified Kneser-Ney by dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        counts = [Counter() for _ in range(order + 1)]
        self.words = Counter()
        for t in texts:
            seq = ["<s>"] * order + t + ["</s>"]
            self.words.update(seq[order:])
            for i in range(order, len(seq)):
                counts[order][tuple(seq[i - order + 1 : i + 1])] += 1
        for m in range(order - 1, 0, -1):
            for g in counts[m + 1]:
                counts[m][g[1:]] += 1
        self.counts = counts
        self.discount, self.context = [None], [None]
        for m in range(1, order + 1):
            n = [sum(c == k for c in counts[m].values()) for k in (1, 2, 3, 4)]
            self.discount.append(kneser_ney.discounts(*n))
            context = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in counts[m].items():
                context[g[:-1]][0] += c
                context[g[:-1]][min(c, 3)] += 1
            self.context.append(context)

    def chance(self, word, before, m=None):
        m = self.order if m is None else m
        if m == 0:
            return 1 / (len(self.words) + 1)
        lower = self.chance(word, before, m - 1)
        h = tuple(before[len(before) - m + 1 :]) if m > 1 else ()
        if h not in self.context[m]:
            return lower
        total, *n = self.context[m][h]
        c = self.counts[m][(*h, word)]
        cut = self.discount[m][min(c, 3) - 1] if c else 0
        return (c - cut) / total + sum(d * k for d, k in zip(self.discount[m], n, strict=True)) / total * lower

    def score(self, t):
        seq = ["<s>"] * self.order + t + ["</s>"]
        return sum(math.log10(self.chance(seq[i], seq[:i])) for i in range(self.order, len(seq)))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_kneser_ney(spark, order):
    r = random.Random(order)
    word = lambda: "w%d" % min(r.randrange(30), r.randrange(30), r.randrange(30))
    rows = [(i, " ".join(word() for _ in range(r.randrange(0, 60))), i % 4 != 1) for i in range(120)]
    rows += [(500, None, True), (501, "", False), (502, "W1 unseen\tw2", None), (None, rows[3][1], False), (3, rows[3][1], True), (503, "w1 w2 " * 20_000, True)]
    docs = spark.createDataFrame([(*x, 1, "s") for x in rows], "doc_id long, text string, train boolean, chunk int, score string")
    texts = [(i, [w.lower() for w in (t or "").split()], train) for i, t, train in rows]
    model = PlainModel([t for _, t, train in texts if train], order)
    total, distinct = sum(model.words.values()), len(model.words)
    expected = []
    for i, t, _ in texts:
        base = sum(math.log10((model.words[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in [*t, "</s>"])
        expected.append((str(i), len(t) + 1, sum(model.words[w] > 0 for w in [*t, "</s>"]), total, base, model.score(t)))
    got = kneser_ney.score_texts(docs, F.col("train"), order=order).collect()
    got = sorted((str(x["doc_id"]), x["n_tokens"], x["n_known"], x["train_tokens"], x["base_score"], x["score"]) for x in got)
    for a, b in zip(got, sorted(expected), strict=True):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-9), (a, b)
    # the chances of all words and one unknown sum to one
    for before in (["<s>"] * order, ["<s>"] * order + ["w1", "w2"]):
        assert abs(sum(model.chance(w, before) for w in [*model.words, "?"]) - 1) < 1e-9


def test_kneser_ney_query_has_trigrams(spark):
    from layercake.llm.queries import op10_kneser_ney

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in docs}
    model = PlainModel([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1], 3)
    got = {r["doc_id"]: r["score"] for r in op10_kneser_ney(spark, SF).collect()}
    assert got.keys() == texts.keys()
    short = [i for i, t in texts.items() if len(t) < 300][:60]
    assert np.allclose([got[i] for i in short], [model.score(texts[i]) for i in short], rtol=1e-9)


def test_kneser_ney_of_copies_is_finite(spark):
    """Every text three times: no n-gram has count 1 or 2, so that estimated discounts would
    be zero. Scores equal the dictionaries' and are finite, also of unseen words."""
    r = random.Random(4)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 12))) for _ in range(20)] * 3
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(100 + i, t, False) for i, t in enumerate(["x z", "a b c", "h x a", "", "b z b z", "a", "q q q q"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").coalesce(1)
    model = PlainModel([t.split() for _, t, train in rows if train], 3)
    got = {x["doc_id"]: x["score"] for x in kneser_ney.score_texts(docs, F.col("train"), order=3).collect()}
    assert all(math.isfinite(x) and x < 0 for x in got.values())
    for i, t, _ in rows:
        assert got[i] == pytest.approx(model.score(t.split()), rel=1e-9)
    assert kneser_ney.discounts(0, 0, 0, 0) == (0.5, 1.0, 1.5) and min(kneser_ney.discounts(1, 50, 50, 50)) > 0


def test_kneser_ney_without_training(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {x["doc_id"]: x for x in kneser_ney.score_texts(docs, F.lit(False)).collect()}
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[1]["score"] == 0.0
    assert kneser_ney.score_texts(docs.where("false"), F.lit(True)).count() == 0


def _shuffle_files(spark) -> dict[str, int]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in (found.apply(i) for i in range(found.size())) if f.getName().startswith("shuffle_")}


def test_kneser_ney_keeps_the_blocks_of_one_order(spark):
    """The blocks of an order are deleted once its answers are written: what is left on disk
    when all is done are the texts, dealt for the scores, and the answers."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(400)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    volume, setting = sum(map(len, texts)), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = set(_shuffle_files(spark)), spark.conf.get(setting)

    def left(most: float) -> int:
        for _ in range(40):  # files are deleted in the background
            size = sum(size for name, size in _shuffle_files(spark).items() if name not in before)
            if size <= most:
                break
            time.sleep(0.25)
        return size

    scored = kneser_ney.score_texts(docs, F.col("doc_id") % 5 > 0, order=3)
    assert left(volume / 100) <= volume / 100
    assert len(scored.collect()) == 200 and spark.conf.get(setting) == was
    assert left(2 * volume) <= 2 * volume
