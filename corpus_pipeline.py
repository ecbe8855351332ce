"""A corpus pipeline: toxicity filter, near-duplicate filter, removal of repeated
passages, benchmark decontamination, tokens.

``STAGES`` are applied in order to ``documents``; the output of each is written and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.llm import byte_bpe, decontamination, toxicity
from layercake.llm.jaccard_join import similarity_classes
from layercake.llm.queries import RANKS, remainder
from layercake.llm.substring_dedup import remove_repeats
from layercake.session import write_scratch


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Columns under numbers, so that no name can clash, and the text's."""
    frame = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    return frame, f"c{docs.columns.index('text')}"


def _named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject. It is fitted on the labels of
    the documents that are not held out. Every row is judged by its text alone, repeated
    rows each; null and empty texts stay. Without labels all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(5) != 0)
    model = toxicity.fit(docs, labels)
    rows, text = _numbered(docs)
    return _named(toxicity.score(rows, model, text_col=text).where("predicted = 0"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of similar documents: that with the smallest id (null ids last),
    of equal ids any one. Rows are told apart by a number of their own, so that repeated rows
    and ids on several texts are classed like all others. Null and blank texts stay."""
    rows, text = _numbered(docs)
    rows = write_scratch(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    classes = similarity_classes(rows, id_col="row", text_col=text).select(F.col("row").alias("member"), "component_id")
    doc_id = F.col(f"c{docs.columns.index('doc_id')}")
    known = write_scratch(classes.join(rows.select("row", doc_id.alias("doc_id")), F.col("member") == F.col("row")).select("row", "component_id", "doc_id"), "classes")
    first = known.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    stays = first.select(F.col("first.row").alias("kept"))
    gone = write_scratch(known.join(stays, F.col("row") == F.col("kept"), "left_anti").select(F.col("row").alias("copy")), "copies")
    return _named(rows.join(gone, F.col("row") == F.col("copy"), "left_anti"), docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that a smaller document has. A text
    that loses nothing stays as it is; one that does keeps its other words, joined by one
    space. Null and empty texts stay as they are; rows with equal ids are one document as
    far as windows go, so that none of them loses words to another; null ids come last."""
    done = remove_repeats(docs, window=13, block=7, carry=docs.columns)
    cut = F.col("n_removed") > 0
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return done.select(*[(F.when(cut, changed[c]).otherwise(F.col("row")[c]) if c in changed else F.col("row")[c]).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with a benchmark item. Every row is judged by its text
    alone, repeated rows each; null and empty texts stay, and all do without a benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, text = _numbered(docs)
    return _named(decontamination.find_overlaps(rows, benchmark, text_col=text).where(F.size("overlaps") == 0), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding. A null text has the tokens of an
    empty one, none; repeated rows are encoded each."""
    tokens = byte_bpe.encode_texts(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN, decoded=True)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), same.alias("decodes"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("benchmark", drop_contaminated),
    ("tokens", tokenize),
]

#: SQL cannot express the classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
