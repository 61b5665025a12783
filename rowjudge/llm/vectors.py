"""What the two vector operators share: usable vectors, exact copies as one, k-means on a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flagged(rows: DataFrame) -> DataFrame:
    """vec_id, embedding, a 128-bit key of it, and ``ok``: an id and a vector of finite numbers that isn't zero.

    Vectors of another length than the most common one (the smaller of two) are not ok. Those that aren't have no embedding."""
    numbers = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.exists("embedding", lambda x: x != 0) & \
        F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    numbers = numbers.withColumn("ok", F.coalesce(good, F.lit(False)))
    sizes = numbers.where("ok").groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    ok = F.col("ok") & (F.size("embedding") == (sizes["n"] if sizes else 0))
    return numbers.select("vec_id", ok.alias("ok"), F.when(ok, F.col("embedding")).alias("embedding"),
                          F.xxhash64(F.lit(1), "embedding").alias("k1"), F.xxhash64(F.lit(2), "embedding").alias("k2"))


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centre, 1)[:, 0]
        count = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        full = count > 0
        centre[full] = total[full] / count[full, None]
        if (~full).any():
            centre[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, nearest first, ties to the smaller number."""
    out = []
    for at in range(0, len(x), 4096):
        part = x[at: at + 4096]
        far = (centre * centre).sum(1) - 2 * part @ centre.T
        out.append(np.argsort(far, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.zeros((0, n), int)
