"""Trained judges: fitted on half of the labelled documents, judged on the other half; one beside a rule, one calibrated, one that
chooses among labels, as columns and in a run."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowjudge.functions import answers as A
from rowjudge.functions.payload import value_payload
from rowjudge.judges import bayes, calibration
from rowjudge.judges.model import ModelJudge
from rowjudge.plans import patterns
from rowjudge.plans.run import judge_rows
from rowjudge.queries.registry import query
from rowjudge.questions import CHOICE, make_question, single
from rowjudge.sources import files
from rowjudge.sources.tables import table

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_TRAINED = f"""
  l AS (SELECT doc_id, text, quality = 1 AS yes, crc32_half FROM (SELECT doc_id, text, quality, doc_id % 2 AS crc32_half
        FROM documents JOIN labels USING (doc_id))),
  w AS (SELECT doc_id, yes, crc32_half, unnest({_WORDS}) AS word FROM l),
  t AS (SELECT word, CAST(count(*) FILTER (yes) AS BIGINT) AS n_yes, CAST(count(*) FILTER (NOT yes) AS BIGINT) AS n_no
        FROM w WHERE crc32_half = 0 GROUP BY word),
  s AS (SELECT count(*) AS v, sum(n_yes) AS ty, sum(n_no) AS tn FROM t),
  p AS (SELECT ln((count(*) FILTER (yes) + 1) / (count(*) FILTER (NOT yes) + 1)) AS prior FROM l WHERE crc32_half = 0),
  e AS (SELECT doc_id, count(*) AS n_known, sum(ln((n_yes + 1) / (ty + v)) - ln((n_no + 1) / (tn + v))) AS evidence
        FROM w JOIN t USING (word), s WHERE crc32_half = 1 GROUP BY doc_id),
  o AS (SELECT doc_id, yes, text, coalesce(n_known, 0) AS n_known, prior + coalesce(evidence, 0) AS log_odds
        FROM l LEFT JOIN e USING (doc_id), p WHERE crc32_half = 1)""".replace("crc32_half", "half")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels"), "doc_id")
    return docs.select("doc_id", "text", (F.col("quality") == 1).alias("yes"), F.pmod("doc_id", F.lit(2)).alias("half"))


@query(f"WITH {_TRAINED} SELECT word, n_yes, n_no FROM t")
def nb_train(spark: SparkSession, sf: str) -> DataFrame:
    return bayes.word_table(_labelled(spark, sf).where("half = 0"), "doc_id", "text", "yes")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf)
    other = labelled.where("half = 1")
    odds = bayes.train(labelled.where("half = 0"), "doc_id", "text", "yes").log_odds(other, "doc_id", "text")
    return other.join(odds, "doc_id")


@query(f"WITH {_TRAINED} SELECT doc_id, CAST(n_known AS BIGINT) AS n_known, round(log_odds, 4) AS log_odds, log_odds > 0 AS predicted FROM o")
def nb_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("doc_id", "n_known", F.round("log_odds", 4).alias("log_odds"), (F.col("log_odds") > 0).alias("predicted"))


@query(f"""WITH {_TRAINED}, j AS (SELECT 'bayes' AS judge, yes, CASE WHEN log_odds > 0 THEN 1.0 ELSE 0.0 END AS p FROM o
  UNION ALL SELECT 'rule', yes, CASE WHEN contains(text, '!!') THEN 0.0 ELSE 1.0 END FROM o)
SELECT judge, count(*) AS n_rows, count(*) FILTER ((p >= 0.5) = yes)::DOUBLE / count(*) AS accuracy, count(*) FILTER (yes) AS positives,
  count(*) FILTER (p >= 0.5 AND yes) AS caught, count(*) FILTER (p >= 0.5 AND NOT yes) AS false_alarms FROM j GROUP BY judge""")
def nb_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The trained judge and a rule of thumb on the half that neither has seen."""
    scored = _scored(spark, sf)
    said = F.array(F.struct(F.lit("bayes").alias("judge"), (F.col("log_odds") > 0).cast("double").alias("probability")),
                   F.struct(F.lit("rule").alias("judge"), (~F.contains("text", F.lit("!!"))).cast("double").alias("probability")))
    each = scored.select(F.col("yes").alias("expected"), F.lit(0).alias("tokens"), F.explode(said).alias("s")).select("expected", "tokens", "s.*")
    report = patterns.quality_report(each, by=["judge"])
    return report.select("judge", "n_rows", "accuracy", "positives", "caught", "false_alarms")


_STEPS = f"""{_TRAINED},
  a AS (SELECT doc_id, yes, greatest(0, least(63, CAST(floor(round(log_odds, 6)) AS BIGINT) + 32)) AS step FROM o),
  k AS (SELECT step, count(*) AS n, count(*) FILTER (yes) AS y FROM a WHERE doc_id % 4 = 1 GROUP BY step),
  m AS (SELECT u.step, lo.step AS lo, hi.step AS hi, sum(x.y) / sum(x.n) AS share FROM k u JOIN k lo ON lo.step <= u.step
        JOIN k hi ON hi.step >= u.step JOIN k x ON x.step BETWEEN lo.step AND hi.step GROUP BY ALL),
  i AS (SELECT step, max(share) AS share FROM (SELECT step, lo, min(share) AS share FROM m GROUP BY step, lo) GROUP BY step),
  r AS (SELECT doc_id, yes, step, coalesce((SELECT max(share) FROM i WHERE i.step <= a.step), (SELECT min(share) FROM i)) AS p
        FROM a WHERE doc_id % 4 = 3)"""


def _calibrated(spark: SparkSession, sf: str) -> DataFrame:
    """The half that training has not seen, halved again: one part calibrates, the other is judged."""
    scored = _scored(spark, sf).withColumn("quarter", F.pmod("doc_id", F.lit(4)))
    shares = calibration.fit(scored.where("quarter = 1"), "log_odds", "yes")
    odds = F.col("log_odds")
    return scored.where("quarter = 3").select("doc_id", "yes", calibration.step_of(odds).alias("step"), shares.probability(odds).alias("probability"))


@query(f"WITH {_STEPS} SELECT doc_id, step, round(p, 6) AS probability FROM r")
def nb_calibrated(spark: SparkSession, sf: str) -> DataFrame:
    return _calibrated(spark, sf).select("doc_id", "step", F.round("probability", 6).alias("probability"))


@query(f"""WITH {_STEPS} SELECT count(*) AS n_rows, count(*) FILTER ((p >= 0.5) = yes)::DOUBLE / count(*) AS accuracy,
  count(*) FILTER (yes) AS positives, count(*) FILTER (p >= 0.5 AND yes) AS caught, count(*) FILTER (p >= 0.5 AND NOT yes) AS false_alarms,
  round(min(p) FILTER (yes), 6) AS lowest_positive, round(max(p) FILTER (NOT yes), 6) AS highest_negative FROM r""")
def nb_calibrated_report(spark: SparkSession, sf: str) -> DataFrame:
    judged = _calibrated(spark, sf).select("probability", F.col("yes").alias("expected"), F.lit(0).alias("tokens"))
    return patterns.quality_report(judged).select(
        "n_rows", "accuracy", "positives", "caught", "false_alarms", F.round("lowest_positive", 6).alias("lowest_positive"),
        F.round("highest_negative", 6).alias("highest_negative"))


_CHOSEN = f"""
  d AS (SELECT doc_id, lang, doc_id % 2 AS half, {_WORDS} AS words FROM documents),
  w AS (SELECT doc_id, lang, half, unnest(words) AS word FROM d),
  c AS (SELECT word, lang AS label, count(*) AS n FROM w WHERE half = 0 AND lang IS NOT NULL GROUP BY ALL),
  t AS (SELECT lang AS label, count(*) AS texts FROM d WHERE half = 0 AND lang IS NOT NULL GROUP BY lang),
  l AS (SELECT label, texts, coalesce(sum(n), 0) AS words, (SELECT count(DISTINCT word) FROM c) AS known,
        (SELECT sum(texts) + count(*) FROM t) AS total FROM t LEFT JOIN c USING (label) GROUP BY label, texts),
  f AS (SELECT doc_id, word FROM w WHERE half = 1 AND word IN (SELECT word FROM c)),
  e AS (SELECT doc_id, l.label, count(*) AS n_known, sum(ln((coalesce(n, 0) + 1) / (words + known))) AS evidence
        FROM f CROSS JOIN l LEFT JOIN c ON c.word = f.word AND c.label = l.label GROUP BY doc_id, l.label),
  s AS (SELECT doc_id, l.label, coalesce(n_known, 0) AS n_known, ln((texts + 1) / total) + coalesce(evidence, 0) AS score
        FROM d CROSS JOIN l LEFT JOIN e USING (doc_id, label) WHERE half = 1),
  x AS (SELECT *, exp(score - max(score) OVER (PARTITION BY doc_id)) AS share FROM s),
  p AS (SELECT doc_id, label, n_known, share / sum(share) OVER (PARTITION BY doc_id) AS p FROM x),
  b AS (SELECT doc_id, label AS choice, n_known, p FROM p QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(p, 9) DESC, label) = 1)"""


def _halves(spark: SparkSession, sf: str) -> tuple[bayes.LabelBayes, DataFrame]:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    half = F.pmod("doc_id", F.lit(2))
    return bayes.train_labels(docs.where(half == 0), "doc_id", "text", "lang"), docs.where(half == 1)


@query(f"WITH {_CHOSEN} SELECT doc_id, CAST(n_known AS BIGINT) AS n_known, choice, round(p, 4) AS probability FROM b")
def nb_choice(spark: SparkSession, sf: str) -> DataFrame:
    model, other = _halves(spark, sf)
    told = model.probabilities(other, "doc_id", "text").withColumn("best", bayes.likeliest(F.col("probabilities")))
    return told.select("doc_id", "n_known", F.col("best.label").alias("choice"), F.round("best.probability", 4).alias("probability"))


def choices(model: bayes.LabelBayes, items: DataFrame) -> DataFrame:
    """What the model says to the items of batches. Each word carries its item's key: a number, not the digest of its batch."""
    text = F.from_json(F.concat(F.lit('{"t":'), "payload", F.lit("}")), "t string")["t"]
    numbered = files.kept(items.select(F.monotonically_increasing_id().alias("item"), "batch_id", "at", text.alias("text")), "items")
    told = model.probabilities(numbered, "item", "text")
    return numbered.select("item", "batch_id", "at").join(told, "item").select("batch_id", "at", "probabilities")


@query(f"WITH {_CHOSEN} SELECT doc_id, choice, round(p, 4) AS confidence FROM b")
def judged_run_by_model(spark: SparkSession, sf: str) -> DataFrame:
    """The same choices through a run: packed into batches, answered by the model, joined back."""
    model, other = _halves(spark, sf)
    question = single(make_question("which language is the text in?", CHOICE, list(model.labels)))
    run = judge_rows(other, value_payload(other, "text"), question, ModelJudge(partial(choices, model)))
    answer = F.col("answers")[0]
    return run.rows.select("doc_id", A.text_field(answer, "choice").alias("choice"), F.round(A.number_field(answer, "confidence"), 4).alias("confidence"))
