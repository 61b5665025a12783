"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

A text is its words and punctuation runs and the pairs of neighbours, hashed into 2^bits places; values are log counts, scaled
to length 1, beside a bias and a step of how repetitive the pairs are. So a score is the logistic of one sparse dot product, whatever the length of the text.

Training reads at most ``train_rows`` labelled documents (those with the smallest hash of their id, a bounded sample) and
makes ``epochs`` passes of per-coordinate FTRL-proximal updates with L1 and L2 terms in one task. The weights have a fixed
size and go to every task. All documents are scored, whole.

Null texts count as empty; empty texts score by the bias. Repeated rows get the same score. With no usable label every
document scores 0.5. Labels other than 0 and 1 are not used; conflicting ones of an id count by their mean. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowjudge.llm.common import released, text_of

_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")


SHARES = 16


@dataclass(frozen=True)
class QualityConfig:
    """alpha, beta: learning rate; l1, l2: regularisation; train_rows: the bound of the training sample;
    negative_weight: how much more a label 0 counts, as the rejected are few."""

    bits: int = 18
    train_rows: int = 20_000
    epochs: int = 4
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.0001
    threshold: float = 0.3
    negative_weight: float = 3.0


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (bias 0, then the step of repetition, then the n-grams) and values."""
    words = np.array([crc32(w) for w in _TOKEN.findall(text.encode("utf-8", "surrogatepass"))], np.uint64)
    mask = np.uint64((1 << bits) - 1)
    one = words * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    two = (words[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[1:]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    place, count = np.unique(np.concatenate([one, two]) & mask, return_counts=True)
    value = np.log1p(count)
    norm = np.sqrt((value * value).sum())
    place = place.astype(np.int64) + 1 + SHARES
    if norm:
        value = value / norm
    # how many of the pairs are different ones, in steps, tells repetition that no single n-gram does
    share = int((SHARES - 1) * len(np.unique(two)) / len(two)) if len(two) else SHARES - 1
    return np.concatenate([[0, 1 + share], place]), np.concatenate([[1.0, 1.0], value])


class Ftrl:
    """Weights by follow-the-regularised-leader: z holds the adjusted gradient sums, n those of their squares."""

    def __init__(self, cfg: QualityConfig):
        self.cfg, size = cfg, (1 << cfg.bits) + 1 + SHARES
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weight(self, at=slice(None)) -> np.ndarray:
        z, n, cfg = self.z[at], self.n[at], self.cfg
        pull = np.maximum(np.abs(z) - cfg.l1, 0) * np.sign(z)
        return -pull / ((cfg.beta + np.sqrt(n)) / cfg.alpha + cfg.l2)

    def learn(self, place: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weight(place)
        slope = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        slope *= 1.0 if label else self.cfg.negative_weight
        n = self.n[place]
        step = (np.sqrt(n + slope * slope) - np.sqrt(n)) / self.cfg.alpha
        self.z[place] += slope - step * w
        self.n[place] = n + slope * slope


def train(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> np.ndarray:
    """Weights (the bias first) from ``docs`` (doc_id, text) and ``labels`` (doc_id, label: 0 or 1)."""
    known = labels.where("label IN (0, 1)").groupBy("doc_id").agg(F.avg("label").alias("mean")).where("mean <> 0.5")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.train_rows)
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # at most train_rows ids
    once = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("mean").alias("mean"))

    def extract(batches):
        for batch in released(batches):
            found = [features(t, cfg.bits) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32())), batch.column(2)],
                names=["h", "place", "value", "label"])

    def fit(batches):
        rows = [row for batch in released(batches) for row in zip(batch.column(1).to_numpy(zero_copy_only=False),
                                                        batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_pylist())]
        model = Ftrl(cfg)
        for epoch in range(cfg.epochs):
            for i in np.random.default_rng(epoch).permutation(len(rows)):
                place, value, label = rows[i]
                model.learn(place, value.astype(np.float64), label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weight().astype("<f4").tobytes()], pa.binary())], names=["weights"])

    rows = once.select(F.xxhash64("doc_id").alias("h"), "text", (F.col("mean") > 0.5).cast("double").alias("label"))
    found = rows.mapInArrow(extract, "h long, place array<int>, value array<float>, label double")
    one = found.repartition(1).sortWithinPartitions("h", "label")  # the bounded sample
    made = one.mapInArrow(fit, "weights binary").first()  # no row where there is no label
    size = (1 << cfg.bits) + 1 + SHARES
    return np.frombuffer(made[0], "<f4").astype(np.float64) if made else np.zeros(size)


def score(docs: DataFrame, weights: np.ndarray, cfg: QualityConfig = QualityConfig(), name: str = "score") -> DataFrame:
    """``docs`` with column ``name``: the probability of label 1."""
    def run(texts):
        for series in released(texts):
            out = []
            for text in series:
                place, value = features(text or "", cfg.bits)
                out.append(1 / (1 + np.exp(-np.clip(weights[place] @ value, -35, 35))))
            yield pd.Series(out, dtype="float64")

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(name, F.pandas_udf(run, "double")("text"))
