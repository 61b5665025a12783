"""Judges that learn: multinomial naive Bayes over words, as grouping and joining, for yes/no questions and for choices.

Words are what white space separates, of whole texts. Training counts each word once per occurrence in texts of either label;
scoring joins a text's word counts with those. Words are counted within their row, where the text is read, so that a word leaves
it once and nothing is shuffled for the counts; one that half of all texts hold joins by salted copies of its row, so no task gets
it whole. :class:`rowjudge.judges.model.ModelJudge` runs it as a judge.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowjudge.operators.lookup import attach, hot_keys
from rowjudge.questions import MAX_OPTIONS
from rowjudge.sources import files

# In UTF-8 the bytes of these characters occur in no other one.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# Words of an Arrow batch.
BATCH_WORDS = 100_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, words, counts = [], [], []

        def told() -> pa.RecordBatch:
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(words, pa.binary()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["key", "word", "n"])

        for row, text in enumerate(batch.column(1)):
            found = Counter(_WORD.findall(text.as_py() or b""))
            rows += [row] * len(found)
            words += found.keys()
            counts += found.values()
            if len(words) >= BATCH_WORDS:
                yield told()
                rows, words, counts = [], [], []
        if words:
            yield told()


def words_of(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, word, n): the words of a row's text and how often it has them; texts without words give no row, rows of one key are
    counted apart."""
    found = texts.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("key", found.schema["key"].dataType), T.StructField("word", T.BinaryType()),
                           T.StructField("n", T.LongType())])
    counted = found.mapInArrow(_counted, schema)
    return counted.select(F.col("key").alias(key), F.col("word").cast("string").alias("word"), "n")


@dataclass(frozen=True)
class NaiveBayes:
    """counts: (word, n_yes, n_no); the totals are those of words and of texts."""

    counts: DataFrame
    words: int
    words_yes: int
    words_no: int
    texts_yes: int
    texts_no: int

    def log_odds(self, texts: DataFrame, key: str, text: str) -> DataFrame:
        """(key, n_known, log_odds) of every text: above zero for yes. Words never seen in training count for nothing."""
        weight = F.log((F.col("n_yes") + 1) / F.lit(float(self.words_yes + self.words))) - \
            F.log((F.col("n_no") + 1) / F.lit(float(self.words_no + self.words)))
        found = words_of(texts, key, text)
        spread = hot_keys(found.groupBy("word").agg(F.count(F.lit(1)).alias("n_rows")), "word")
        weighed = attach(found, self.counts.select("word", weight.alias("w")), "word", spread, salt=F.xxhash64(key))
        sums = weighed.where(F.col("w").isNotNull()).groupBy(key).agg(
            F.sum("n").alias("n_known"), F.sum(F.col("n") * F.col("w")).alias("evidence"))
        prior = F.log(F.lit((self.texts_yes + 1) / (self.texts_no + 1)))
        return texts.select(key).join(sums, key, "left").select(
            key, F.coalesce("n_known", F.lit(0)).alias("n_known"), (prior + F.coalesce("evidence", F.lit(0.0))).alias("log_odds"))


def word_table(labelled: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(word, n_yes, n_no) over texts with a boolean label."""
    found, yes = words_of(labelled.where(F.col(label).isNotNull()), label, text), F.col(label)
    return found.groupBy("word").agg(F.sum(F.when(yes, F.col("n")).otherwise(0)).alias("n_yes"),
                                     F.sum(F.when(yes, 0).otherwise(F.col("n"))).alias("n_no"))


def train(labelled: DataFrame, key: str, text: str, label: str) -> NaiveBayes:
    """Five totals reach the driver, the word table is a written one: each scoring reads it."""
    counts = files.kept(word_table(labelled, key, text, label), "words")
    texts = labelled.agg(F.count_if(F.col(label)), F.count_if(~F.col(label))).first()
    words = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_yes"), F.lit(0)), F.coalesce(F.sum("n_no"), F.lit(0))).first()
    return NaiveBayes(counts, *words, *texts)


@dataclass(frozen=True)
class LabelBayes:
    """weights: (word, w), where ``w`` has an entry per label, as the prior has."""

    labels: tuple[str, ...]
    weights: DataFrame
    prior: tuple[float, ...]

    def probabilities(self, texts: DataFrame, key: str, text: str) -> DataFrame:
        """(key, n_known, probabilities by label) of every text; texts without a known word get the prior."""
        found = words_of(texts, key, text)
        spread = hot_keys(found.groupBy("word").agg(F.count(F.lit(1)).alias("n_rows")), "word")
        weighed = attach(found, self.weights, "word", spread, salt=F.xxhash64(key)).where(F.col("w").isNotNull())
        sums = weighed.groupBy(key).agg(F.sum("n").alias("n_known"), *[
            F.sum(F.col("n") * F.col("w")[i]).alias(f"_e{i}") for i in range(len(self.labels))])
        logs = F.array(*[F.lit(p) + F.coalesce(F.col(f"_e{i}"), F.lit(0.0)) for i, p in enumerate(self.prior)])
        scored = texts.select(key).join(sums, key, "left").select(key, F.coalesce("n_known", F.lit(0)).alias("n_known"), logs.alias("_logs"))
        shares = scored.withColumn("_p", F.transform("_logs", lambda x: F.exp(x - F.array_max("_logs"))))
        total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
        labels = F.array(*map(F.lit, self.labels))
        return shares.select(key, "n_known", F.map_from_arrays(labels, F.transform("_p", lambda x: x / total)).alias("probabilities"))


def likeliest(probabilities: Column) -> Column:
    """(label, probability) of the greatest probability; those that agree to nine places tie, and the smallest label wins."""
    ranked = F.transform(F.map_entries(probabilities), lambda e: F.struct(
        (-F.round(e["value"], 9)).alias("order"), e["key"].alias("label"), e["value"].alias("probability")))
    return F.array_min(ranked)


def label_table(labelled: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """(word, label, n) over texts that have a label."""
    found = words_of(labelled.where(F.col(label).isNotNull()), label, text)
    return found.groupBy("word", F.col(label).alias("label")).agg(F.sum("n").alias("n"))


def train_labels(labelled: DataFrame, key: str, text: str, label: str) -> LabelBayes:
    """Two totals a label reach the driver; there may be as many labels as a choice has options. Texts without a label teach nothing."""
    counts = files.kept(label_table(labelled, key, text, label), "words")
    texts = labelled.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("texts"))
    words = counts.groupBy("label").agg(F.sum("n").alias("words"))
    totals = sorted(texts.join(words, "label", "left").limit(MAX_OPTIONS + 1).collect())
    if not 0 < len(totals) <= MAX_OPTIONS:
        raise ValueError(f"a choice is learned from 1 to {MAX_OPTIONS} labels")
    by_word = counts.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("n"))
    known, n_texts = by_word.count(), sum(t.texts for t in totals)
    weights = [F.log((F.coalesce(F.col("n")[t.label], F.lit(0)) + 1) / F.lit(float((t.words or 0) + known))) for t in totals]
    prior = tuple(log((t.texts + 1) / (n_texts + len(totals))) for t in totals)
    return LabelBayes(tuple(t.label for t in totals), by_word.select("word", F.array(*weights).alias("w")), prior)
