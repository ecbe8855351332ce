"""Registered queries of the operators of this subpackage, and their SQL.

Every query applies its operator with production parameters to a whole table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm import byte_bpe, conversation_repair, decontamination, kneser_ney, language_id, lexical_search, quality_classifier, sharding, toxicity
from layercake.llm.jaccard_join import similarity_classes
from layercake.llm.substring_dedup import remove_repeats
from layercake.llm.suffix_dedup import find_repeats
from layercake.llm.top_k import top_k
from layercake.session import write_scratch

#: Files of public vocabularies.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTILINGUAL_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(by: int, id_col: str = "doc_id"):
    """crc32 of the id as text modulo ``by``; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(by)), F.lit(-1))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(4) == 2
    model = language_id.fit(docs.where(~held_out), MULTILINGUAL_RANKS)
    return language_id.predict(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the bytes that they decode to."""
    docs = _table(spark, sf_dir, "documents")
    tokens = byte_bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, decoded=True, keep=["doc_id"])
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best vectors of every hundredth vector."""
    return top_k(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that another document has too."""
    found = find_repeats(_table(spark, sf_dir, "documents"), min_words=50)
    return found.select("doc_id", "n_words", "n_repeated", "n_removable", F.explode("spans").alias("span")).select(
        "doc_id", "n_words", "n_repeated", "n_removable", F.col("span.first").cast("long").alias("first_word"), F.col("span.end").cast("long").alias("end_word")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in shards of near equal bytes; equal texts stay together."""
    dealt = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of those not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(5) == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.score(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages, with the best overlap of each item."""
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontamination.find_overlaps(docs, benchmark, keep=["doc_id"]).select("doc_id", F.explode("overlaps").alias("o"))
    return found.select("doc_id", F.col("o.item").alias("item_id"), "o.text_first", "o.text_end", "o.item_first", "o.n_equal")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removal of 13-word windows that a smaller document has."""
    done = remove_repeats(_table(spark, sf_dir, "documents"), window=13, block=7)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by similar sets of 5-word n-grams."""
    return similarity_classes(_table(spark, sf_dir, "documents"), shingle=5, percent=80)


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a model of those not held out."""
    scored = kneser_ney.score_texts(_table(spark, sf_dir, "documents"), remainder(5) != 1, order=3)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with turns dropped, emptied, cut, repeated and given to the user,
    by the crc32 of ``conv_id:turn`` modulo 20. Nulls are one space."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    fate = F.pmod(F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")), F.lit(20))
    copies = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    conversations = _table(spark, sf_dir, "conversations")
    rows = damaged(conversations)
    repairs = write_scratch(conversation_repair.find_repairs(rows), "repairs")
    digests = conversation_repair.repaired_digests(rows, repairs).withColumnRenamed("conv_id", "d_conv")
    names = conversations.select(F.col("conv_id").alias("all_conv")).distinct()
    whole = names.join(repairs, F.col("all_conv").eqNullSafe(F.col("conv_id")), "left").join(digests, F.col("all_conv").eqNullSafe(F.col("d_conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select(F.col("all_conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels of those not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = remainder(5) == 0
    model = quality_classifier.fit(docs, labels.where(~held_out))
    return quality_classifier.score(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    index, texts = lexical_search.build_index(_table(spark, sf_dir, "documents"))
    return lexical_search.search(index, texts, _table(spark, sf_dir, "benchmark"), k=50)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_top_k": op3_top_k,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sharding": op5_sharding,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_lexical_search": op13_lexical_search,
}

_WORDS = r"'[^\x20\x09-\x0D]+'"
_TEXTS = f"texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents)"
_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _way(way: str, cost: int | str, edit: str) -> str:
    """A way of operator 11's SQL, a cost of six digits and edits, with one more edit."""
    return f"lpad((left({way}, 6)::INTEGER + {cost})::VARCHAR, 6, '0') || substr({way}, 7) || '{edit}'"


ORACLE_SQL = {
    "op3_top_k": """
        WITH whole AS (
          SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT q.r, q.vec_id AS query_id, c.vec_id,
                 list_inner_product(q.v, c.v)::BIGINT AS score
          FROM whole AS q JOIN whole AS c ON c.r <> q.r AND len(c.v) = len(q.v)
          WHERE q.vec_id % 100 = 0),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank
          FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op4_suffix_dedup": f"""
        WITH {_TEXTS},
        starts AS (
          SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM texts WHERE len(ws) >= 50),
        windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM starts),
        seen AS (SELECT k, min(doc_id) AS lo, max(doc_id) AS hi FROM windows GROUP BY k HAVING lo < hi),
        hits AS (SELECT doc_id, i, lo < doc_id AS later FROM windows JOIN seen USING (k)),
        words AS (
          SELECT doc_id, i + j AS pos, bool_or(later) AS later
          FROM hits, range(0, 50) AS r(j) GROUP BY doc_id, pos),
        runs AS (
          SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM words),
        spans AS (SELECT doc_id, min(pos) - 1 AS a, max(pos) AS b FROM runs GROUP BY doc_id, run),
        sums AS (
          SELECT doc_id, count(*) AS n_repeated, count(*) FILTER (later) AS n_removable
          FROM words GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, n_repeated, n_removable,
               a::BIGINT AS first_word, b::BIGINT AS end_word
        FROM spans JOIN sums USING (doc_id) JOIN texts USING (doc_id)
    """,
    "op8_substring_dedup": f"""
        WITH {_TEXTS},
        starts AS (
          SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM texts WHERE len(ws) >= 13),
        windows AS (
          SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM starts),
        least AS (SELECT k, min(doc_id) AS lo FROM windows GROUP BY k),
        gone AS (
          SELECT DISTINCT doc_id, i + j AS pos
          FROM windows JOIN least USING (k), range(0, 13) AS r(j) WHERE lo < doc_id),
        words AS (
          SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM texts),
        kept AS (
          SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY pos) AS s
          FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
        SELECT texts.doc_id, len(ws)::BIGINT AS n_words,
               (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(s, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (doc_id)
    """,
    "op9_jaccard_join": f"""
        WITH RECURSIVE texts AS (
          SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM documents),
        grams AS (
          SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
          FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM texts WHERE len(ws) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        common AS (
          SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m
          FROM grams AS x JOIN grams AS y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY a, b),
        links AS (
          SELECT a, b FROM common JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
          WHERE 100 * m >= 80 * (p.n + q.n - m)),
        reach(a, b) AS (
          SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT t.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
               least(t.doc_id, coalesce(min(b), t.doc_id)) AS component_id
        FROM texts AS t LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.a = t.doc_id
        GROUP BY t.doc_id
    """,
    "op11_conversation_repair": f"""
        WITH RECURSIVE keyed AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS k
          FROM conversations),
        hashed AS (
          SELECT *, list_reduce(
              list_transform(k, lambda c: ascii(c)::BIGINT),
              lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)),
              4294967295) AS crc
          FROM keyed),
        fated AS (SELECT *, xor(crc, 4294967295) % 20 AS fate FROM hashed),
        turns AS (
          SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, copy,
                 CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM fated, range(0, 2) AS r(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
                 NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank
          FROM turns),
        marked AS (
          SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
                 lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal
          FROM numbered),
        judged AS (
          SELECT *, NOT blank AND NOT duplicate AS free,
                 (NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$'))::INTEGER AS cut
          FROM marked),
        -- the cheapest way to each state (nothing, system, user, assistant): six digits of cost, then edits
        ways(conv_id, i, n, y, u, a) AS (
          SELECT DISTINCT conv_id, 0::BIGINT, '000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM judged
          UNION ALL
          SELECT w.conv_id, j.i, {_way("n", 3, "D")},
                 least({_way("y", 3, "D")}, CASE WHEN free AND role[1] = 's' THEN {_way("n", "cut", "K")} END),
                 least({_way("u", 3, "D")}, CASE WHEN free THEN {_way("least(n, y, a)", "cut + 2", "R")} END,
                       CASE WHEN free AND role[1] = 'u' THEN {_way("least(n, y, a)", "cut", "K")} END),
                 least({_way("a", 3, "D")}, CASE WHEN free THEN {_way("u", "cut + 2", "R")} END,
                       CASE WHEN free AND role[1] = 'a' THEN {_way("u", "cut", "K")} END)
          FROM (SELECT conv_id, i, n, y, u, least(a, {_way("u", 2, "I")}) AS a
                FROM (SELECT conv_id, i, n, y, a, least(u, {_way("least(n, y, a)", 2, "I")}) AS u FROM ways)) AS w
          JOIN judged AS j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1),
        best AS (
          SELECT conv_id, left(way, 6)::BIGINT AS cost, substr(way, 7) AS audit
          FROM (SELECT conv_id, least(n, a, {_way("least(u, " + _way("least(n, y, a)", 2, "I") + ")", 2, "I")}) AS way
                FROM ways WHERE (conv_id IS NULL, coalesce(conv_id, 0), i) IN (
                  SELECT (conv_id IS NULL, coalesce(conv_id, 0), max(i)) FROM judged GROUP BY conv_id))),
        -- p: edits done, i: turns used, said: last initial
        replay(conv_id, audit, p, i, said, out) AS (
          SELECT conv_id, audit, 0, 0::BIGINT, '', NULL::VARCHAR FROM best
          UNION ALL
          SELECT conv_id, audit, p + 1, i, CASE WHEN line IS NULL THEN said ELSE line[1] END,
                 CASE WHEN line IS NULL THEN out WHEN out IS NULL THEN line ELSE out || chr(10) || line END
          FROM (
            SELECT r.conv_id, audit, p, said, out, coalesce(j.i, r.i) AS i,
                   CASE audit[p + 1] WHEN 'I' THEN spoken || ':' WHEN 'R' THEN spoken || ':' || text WHEN 'K' THEN role || ':' || text END AS line
            FROM (SELECT *, CASE said WHEN 'u' THEN 'assistant' ELSE 'user' END AS spoken FROM replay WHERE p < len(audit)) AS r
            LEFT JOIN judged AS j ON audit[p + 1] <> 'I' AND j.conv_id IS NOT DISTINCT FROM r.conv_id AND j.i = r.i + 1)),
        faults AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count_if(blank) AS blank, count_if(duplicate) AS duplicate, sum(cut) AS truncated, count_if(illegal) AS illegal
          FROM judged GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
               coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(out, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS c
        LEFT JOIN faults ON faults.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN replay ON replay.conv_id IS NOT DISTINCT FROM c.conv_id AND p = len(replay.audit)
    """,
    "op13_lexical_search": f"""
        WITH texts AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_TERMS}) AS ts FROM documents),
        sizes AS (SELECT count(*) AS texts, sum(len(ts))::BIGINT AS terms FROM texts WHERE len(ts) > 0),
        held AS (
          SELECT r, t, any_value(doc_id) AS doc_id, any_value(n) AS n, count(*) AS tf
          FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM texts) GROUP BY r, t),
        weights AS (
          SELECT t, floor(1000 * ln((2 * any_value(texts) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
          FROM held, sizes GROUP BY t),
        asked AS (
          SELECT DISTINCT q, item_id, t FROM (
            SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all({_LOWER}, {_TERMS})) AS t FROM benchmark)),
        scored AS (
          SELECT q, r, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id,
                 sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * texts) // terms))))::BIGINT AS score
          FROM asked JOIN weights USING (t) JOIN held USING (t), sizes GROUP BY q, r),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank
          FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
