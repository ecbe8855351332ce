"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from layercake.llm.queries import ORACLE_SQL, QUERIES
from layercake.session import write_scratch

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_operators_and_the_pipeline_are_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    want = Counter(tuple(row[names.index(c)] for c in cols) for row in result.fetchall())
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == want


def test_result_columns(spark):
    first = {
        "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op2_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op5_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op10_kneser_ney": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    }
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, columns in first.items():
        got = QUERIES[name](spark, SF)
        assert got.columns[: len(columns)] == columns
        assert got.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty() and got.count() == docs.count()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages(spark):
    """Each stage on what its predecessor kept, with extra columns named like those of
    the operators, null texts and ids, and repeated rows."""
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    columns = docs.columns
    extra = ["score", "row", "overlaps", "n_words", "chunk"]
    odd = spark.createDataFrame([(None, None, None, None, None), (70_001, None, "en", "s", 0), (70_002, "", None, "s", 0), (None, "no id", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(1))
    for c in extra:
        docs = docs.withColumn(c, F.lit(c))
    before = write_scratch(docs, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "repeats", "benchmark", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        after = write_scratch(stage(spark, before, MORE), name)
        old, new = before.collect(), after.collect()
        if name != "tokens":
            assert after.columns == columns + extra and {r["score"] for r in new} == {"score"}
        if name in ("toxicity", "near_copies", "benchmark"):
            assert not Counter(new) - Counter(old)
            kept = {r["doc_id"] for r in new}
            assert {70_001, 70_002} <= kept and sum(r["doc_id"] is None for r in new) == 2
        if name == "toxicity":
            rude = {"idiot", "moron", "stupid", "scum", "clown", "pathetic", "worthless", "trash", "loser", "disgusting"}
            has = {r["doc_id"]: bool(rude & set(re.findall(r"[a-z]+", (r["text"] or "").lower()))) for r in old}
            gone = {r["doc_id"] for r in old} - kept
            assert gone and all(has[i] for i in gone) and sum(has[i] for i in kept) <= 0.1 * len(gone)
            # brute force from here on: a quarter of the documents
            after = after.where("doc_id % 4 = 0 OR doc_id > 70000 OR doc_id IS NULL OR doc_id < 50")
        if name == "near_copies":
            sets = {}
            for r in new:
                w = [x.lower() for x in words_of(r["text"])]
                sets[r["doc_id"]] = {tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set()
            ids = [i for i in sets if sets[i]]
            for a in ids:
                for b in ids:
                    m = len(sets[a] & sets[b])
                    assert a == b or 100 * m < 80 * (len(sets[a]) + len(sets[b]) - m)
            assert len(new) < len(old)
        if name == "repeats":
            first = defaultdict(set)
            by_id = {r["doc_id"]: r["text"] for r in old if r["doc_id"] is not None}
            for i, t in by_id.items():
                w = words_of(t)
                for p in range(len(w) - 12):
                    first[tuple(w[p : p + 13])].add(i)
            got = {r["doc_id"]: r for r in new}
            for i, t in by_id.items():
                w = words_of(t)
                gone = {q for p in range(len(w) - 12) if min(first[tuple(w[p : p + 13])]) < i for q in range(p, p + 13)}
                assert got[i]["text"] == (" ".join(x for p, x in enumerate(w) if p not in gone) if gone else t)
                assert not gone or got[i]["n_chars"] == len(got[i]["text"])
        if name == "tokens":
            assert all(r["decodes"] for r in new) and len(new) == len(old)
        before = write_scratch(after, "next")


def test_near_copies_keep_one_row_of_each_class(spark):
    """Whatever the ids: repeated rows, an id on two texts, null ids."""
    t, u = (" ".join(f"{w}{i}" for i in range(30)) for w in "tu")
    rows = [(1, t), (1, t), (2, u), (2, t), (None, t), (None, t), (None, None), (3, None), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, x, "en", "s", 1, "row") for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long, row string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    want = [(1, t), (2, u), (None, None), (3, None), (3, None), (4, "")]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(want)


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    for stage in corpus_pipeline.STAGES:
        assert stage[1](spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
