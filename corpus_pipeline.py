"""From raw documents to packed training sequences: quality, near duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; what it returns is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``docs``. Null texts count as empty
throughout; a table without rows passes through. Rows without an id are kept apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowjudge.llm import jaccard_join, mixing, packing, pii, quality
from rowjudge.llm.common import stored, unused
from rowjudge.llm.queries import TOKENIZER
from rowjudge.sources.tables import table

#: No SQL expresses the trained stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, where there is one, counted again."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, trained on ``labels``, rejects."""
    cfg = quality.QualityConfig()
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    score = unused(docs, "_score")
    scored = quality.score(docs, quality.train(docs, labels, cfg), cfg, score)
    return scored.where(F.col(score) >= cfg.threshold).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each class of near duplicates the row with the smallest id (of equal ids the one whose text has the smallest hash).
    Rows without words are no one's duplicate; of rows that are wholly alike in id and text one stays. A row without an id gets a
    large one made from its text, so it goes only where its class has another."""
    made = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2).bitwiseOR(F.lit(1 << 62))
    key, tag = unused(docs, "_id"), unused(docs, "_tag")
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id"), made)).withColumn(tag, F.xxhash64(F.coalesce("text", F.lit(""))))
    classes = jaccard_join.jaccard_classes(keyed.select(F.col(key).alias("doc_id"), "text"))
    wordless = F.col("n_shingles") == 0
    apart = F.when(wordless, F.struct("doc_id", "tag"))
    first = classes.groupBy(F.when(~wordless, F.col("class")).alias("class"), apart.alias("apart")).agg(F.min(F.struct("doc_id", "tag")).alias("first"))
    first = first.select(F.col("first.doc_id").alias(key), F.col("first.tag").alias(tag))
    return keyed.join(first, [key, tag]).dropDuplicates([key, tag]).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by marks of its kind."""
    return _measured(pii.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes of each source the words its target weight asks for: documents repeat, stay, or are taken in part."""
    return _measured(mixing.mixed_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1,024 tokens."""
    return packing.pack(docs, packing.PackConfig(TOKENIZER))


STAGES = [("quality", keep_quality), ("near duplicates", keep_distinct), ("personal data", mask_personal_data),
          ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
