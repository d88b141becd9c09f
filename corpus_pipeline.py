"""From raw documents to packed training sequences.

Five stages, each on all that the one before kept, written as Parquet and read again:
documents in no known language go, then those of low quality; of near copies one stays;
personal data is replaced by its kind; what is left is packed.  Rows that share a doc_id are
one document, of which each different text stays once.  A document without an id can't be a
copy and stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm.common import fold, ready, staged, table
from lakekit.llm.jaccard_join import jaccard_components
from lakekit.llm.language_id import FOLDS, HELD_OUT, UNKNOWN, predict_language, train_language_model
from lakekit.llm.packing import pack_documents
from lakekit.llm.pii import redact
from lakekit.llm.quality_model import PREDICT_AT, score_quality, train_quality
from lakekit.llm.queries import WORD_BPE

COPY_WORDS, COPY_PERCENT = 5, 80    # near copies: shingles of five words, similarity 0.8 or more
LEAST_LANGUAGE_SCORE = 0.3      # below, no language is likelier than not to be the text's


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores in front as no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while taken & {n.lower() for n in names}:
        names = tuple(f"_{n}" for n in names)
    return [*names]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised (texts without a letter are not)."""
    ready(spark)
    model = train_language_model(docs, fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    if not model.languages:     # nothing to learn from: no document is rejected
        return docs
    lang, score = free_names(docs, "_lang_pred", "_lang_score")
    scored = predict_language(docs, model, lang_out=lang, score_out=score)
    return scored.where((F.col(lang) != UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learnt from the labels, takes for good ones."""
    ready(spark)
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    # the partition id keeps Spark from pushing the test below the statistics, where each rule would compute its own
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))     # no name of a document can clash
    scored = score_quality(rows, model, text_col="_text", score_out="_quality").withColumn("_partition", F.spark_partition_id())
    return scored.where((F.col("_quality") >= PREDICT_AT) & (F.col("_partition") >= 0)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.  Of rows that
    share it, one stays for each different text (the one whose columns come first as JSON)."""
    ready(spark)
    copies = jaccard_components(docs, words=COPY_WORDS, percent=COPY_PERCENT).where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    copies, repeated = staged(copies, "pipeline-copies"), staged(repeated, "pipeline-repeated")
    left = docs.join(copies, "doc_id", "left_anti")
    again = left.join(repeated, "doc_id", "left_semi").select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    once = again.groupBy("doc_id", "text").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")
    return left.join(repeated, "doc_id", "left_anti").select(*docs.columns).union(once.select(*docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced and n_chars counted anew."""
    ready(spark)
    clean = redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences."""
    ready(spark)
    return pack_documents(docs, WORD_BPE)


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", packing)]

# Learnt models, near copies and a packing are beyond SQL: tests/llm/test_pipeline.py has plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one's rows are written to the shared folder."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
