"""A corpus through five filters of the llm subpackage: toxicity, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns all documents it keeps, with the columns of ``documents``; the last
returns the packed pieces. Stages decide row by row: rows that share an id, or have none, are judged on their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, ngram_join, packing, substrings, toxicity
from tidemark.llm.catalogue import tokenizer_path
from tidemark.llm.tables import lasting, load, passing, staged, without


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; the score is one of the text alone, so the verdict is too."""
    scored = toxicity.score_documents(docs, load(spark, sf_dir, "labels"))
    return without(docs, F.xxhash64("text"), scored.filter("predicted = 1").select("text_hash"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by a Jaccard similarity of 0.8 of 5-word shingles: the one with the smallest id,
    of rows that share it or have none the first. Rows are linked, whatever their ids."""
    name = next(f"row_{k}" for k in range(len(docs.columns) + 1) if f"row_{k}" not in docs.columns)
    rows = staged(docs.withColumn(name, F.monotonically_increasing_id()), "rows")  # written, so that numbers stay
    with passing():  # of all the tables of the join no more than the rows to leave out is kept
        classes = ngram_join.jaccard_classes(rows, id_col=name, k=5, percent=80)
        own = rows.select(F.col(name).alias("id"), "doc_id").join(classes, "id").select("id", "component_id", F.struct(
            F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("id").alias("row")).alias("place"))
        first = own.groupBy("component_id").agg(F.min("place").alias("first"))
        later = own.join(first, "component_id").filter(F.col("id") != F.col("first.row")).select("id")
        with lasting():
            later = staged(later, "later")
    return without(rows, F.col(name), later).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id has are cut; a document left without words goes."""
    before = docs.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    wordless = docs.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    cut = substrings.drop_repeats(before).filter("text <> ''")
    now = F.when(F.col("n_chars").isNotNull(), F.length("text").cast("bigint"))
    return cut.withColumn("n_chars", now).unionByName(wordless)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; rows of one text have one verdict, so texts stand for their rows."""
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    marked = decontaminate.mark_documents(texts, load(spark, sf_dir, "benchmark"))
    return without(docs, F.xxhash64("text"), marked.filter("contaminated").select("id"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("substring_dedup", cut_repeats),
          ("decontamination", drop_leaks), ("packing", pack)]

#: Classifier, tokenizer and packing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over a table that the one before has written."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
