"""A corpus made ready for training: stages applied to ``documents`` one after another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import bpe, decontaminate, line_dedup, near_dups, quality, queries
from tallyfold.llm.frames import quoted
from tallyfold.session import materialize

#: Words of a shingle of the near-duplicate stage; op7 takes two by its own contract.
SHINGLE = 5


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all columns but the text as one, out of the way of an operator's own."""
    rest = [quoted(name) for name in docs.columns if name != "text"]
    return docs.select("doc_id", "text", F.struct(*rest).alias("_doc"))


def unpacked(rows: DataFrame, columns: list[str], changed: Column | None = None) -> DataFrame:
    """The columns of documents again; where ``changed`` holds, n_chars is that of the text left."""
    out = []
    for name in columns:
        column = F.col("text") if name == "text" else F.col("_doc").getField(name)
        if name == "n_chars" and changed is not None:
            column = F.when(changed, F.length("text").cast("long")).otherwise(column)
        out.append(column.alias(name))
    return rows.select(*out)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, learnt on the labelled ones, does not reject."""
    numbers = materialize(quality.with_features(docs.select("doc_id", "text")).drop("text"), "features")
    model = quality.train(numbers, queries.table(spark, sf_dir, "labels"))
    scored = quality.rated(packed(docs), model)
    return unpacked(scored.filter(F.col("score") >= queries.QUALITY_FLOOR), docs.columns)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without blocks of lines that stand in an earlier document.

    A document all of whose lines go is a copy, and goes too. Texts of one line are left to the next stage.
    """
    left = line_dedup.without_repeated_lines(packed(docs), one_line=False)
    changed = F.size("removed") > 0
    emptied = F.coalesce(changed & (F.trim("text") == ""), F.lit(False))
    return unpacked(left.filter(~emptied), docs.columns, changed)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each class of near-duplicates on 5-word shingles."""
    classes = near_dups.near_duplicate_classes(docs, size=SHINGLE)
    others = classes.filter("not kept").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages they share with the benchmark.

    A document all of whose words are such passages goes.
    """
    found = decontaminate.contaminated(packed(docs), queries.table(spark, sf_dir, "benchmark"))
    hit = F.size("hits") > 0
    whole = hit & (decontaminate.hit_words("hits") == F.col("n_words"))
    cut = found.filter(~whole).withColumn("text", decontaminate.without_hits("text", "hits"))
    return unpacked(cut, docs.columns, hit)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    texts = docs.select("doc_id", "source", "lang", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_digest"))
    return bpe.round_trip(texts, queries.tokenizer_path()).select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("_digest") == F.sha2("decoded", 256)).alias("round_trip"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", unrepeated_lines),
    ("near_duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("tokens", tokens),
]

#: Trained models and fingerprints of whole texts have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
