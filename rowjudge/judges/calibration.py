"""From log odds to probabilities that can be believed: isotonic regression over steps of the log odds.

Labelled rows are counted per step of one, from -32 to 31 and beyond at either end, so 64 counts reach the driver whatever the
table. Neighbouring steps whose shares of yes fall are pooled until the shares rise. A step that no labelled row has takes the
value of the next lower one that has some, or of the lowest.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 64


def step_of(log_odds: Column) -> Column:
    """The step from 0 to 63; rounding keeps sums that differ in their last bits together."""
    whole = F.floor(F.round(log_odds, 6)).cast("bigint") + STEPS // 2
    return F.when(log_odds.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(STEPS - 1), whole)))


def pooled(counts: Iterable[tuple[int, int, int]]) -> list[tuple[int, float]]:
    """(step, share) of (step, n_rows, n_yes) in order of the steps, shares never falling."""
    blocks: list[tuple[list[int], int, int]] = []
    for step, n, yes in counts:
        steps = [step]
        while blocks and blocks[-1][2] * n >= yes * blocks[-1][1]:
            before, n_before, yes_before = blocks.pop()
            steps, n, yes = before + steps, n + n_before, yes + yes_before
        blocks.append((steps, n, yes))
    return [(step, yes / n) for steps, n, yes in blocks for step in steps]


@dataclass(frozen=True)
class Calibration:
    """shares: a probability per step."""

    shares: tuple[float, ...]

    def probability(self, log_odds: Column) -> Column:
        """NULL log odds stay NULL."""
        return F.get(F.array(*map(F.lit, self.shares)), step_of(log_odds))


def fit(labelled: DataFrame, log_odds: str, yes: str) -> Calibration:
    """Rows without log odds or without a label teach nothing; an error where none is left."""
    told = labelled.where(F.col(log_odds).isNotNull() & F.col(yes).isNotNull())
    counts = told.groupBy(step_of(F.col(log_odds)).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.count_if(yes).alias("yes")).collect()
    if not counts:
        raise ValueError("no labelled row to calibrate with")
    known = dict(pooled(sorted(map(tuple, counts))))
    shares, share = [], known[min(known)]
    for step in range(STEPS):
        share = known.get(step, share)
        shares.append(share)
    return Calibration(tuple(shares))
