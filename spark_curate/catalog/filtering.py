"""Queries on prompt-group scores and keep / reject decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_curate.catalog import inputs as I
from spark_curate.functions import columns as C
from spark_curate.operators import scoring

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@register(
    "group_scores",
    I.sql("SELECT image, positive, negative, overlay, clean FROM scores", "scores"),
)
def group_scores(spark, sf_dir):
    return I.scores(spark, sf_dir).drop("label")


@register("filter_decisions", I.sql("SELECT * FROM decisions", "decisions"))
def filter_decisions(spark, sf_dir):
    return I.decisions(spark, sf_dir)


#: A second run: every eleventh item was kept by the first, every thirteenth cannot be read.
RESUMED = {
    "again": """SELECT s.image, i.vec_id % 11 = 3 AS done, i.vec_id % 13 = 5 AS broken,
      CASE WHEN i.vec_id % 13 <> 5 THEN positive END AS positive, CASE WHEN i.vec_id % 13 <> 5 THEN negative END AS negative,
      CASE WHEN i.vec_id % 13 <> 5 THEN overlay END AS overlay, CASE WHEN i.vec_id % 13 <> 5 THEN clean END AS clean
      FROM scores s JOIN items i ON i.image = s.image""",
    "resumed": """SELECT *, coalesce(overlay - clean > 0.01, false) AS flagged,
      CASE WHEN coalesce(overlay - clean > 0.01, false) THEN 'overlay' WHEN done THEN 'resume_existing'
           WHEN positive IS NULL THEN 'load_error'
           WHEN positive >= 0.0025 AND positive > negative THEN 'passed' ELSE 'low_score' END AS reason FROM again""",
    "resumed_log": """SELECT image, CASE WHEN NOT flagged AND NOT done THEN positive END AS positive,
      CASE WHEN NOT flagged AND NOT done THEN negative END AS negative, overlay, clean, flagged,
      reason IN ('passed', 'resume_existing') AS kept, reason FROM resumed""",
}


def resumed_decisions(spark, sf_dir):
    scored = I.scores(spark, sf_dir).join(I.items(spark, sf_dir).select("image", "vec_id"), "image")
    readable = F.col("vec_id") % 13 != 5
    scores = [F.when(readable, F.col(g)).alias(g) for g in scoring.GROUPS]
    first_run = scored.where("vec_id % 11 = 3").select("image")
    return scoring.filter_decisions(scored.select("image", *scores), I.THRESHOLDS, existing=first_run)


@register("filter_resume", I.sql("SELECT * FROM resumed_log", "scores", extra=RESUMED))
def filter_resume(spark, sf_dir):
    """Decisions of a resumed run, where all five reasons occur."""
    return resumed_decisions(spark, sf_dir)


@register(
    "decision_counts",
    I.sql(
        """SELECT count(*) AS total, count(*) FILTER (kept) AS kept,
        count(*) FILTER (reason='low_score') AS discarded_target,
        count(*) FILTER (reason='overlay') AS discarded_overlay,
        count(*) FILTER (reason='load_error') AS errors FROM decisions""",
        "decisions",
    ),
)
def decision_counts(spark, sf_dir):
    return scoring.decision_counts(I.decisions(spark, sf_dir))


MARGINS = {
    "m": """SELECT *, positive - 0.0025 AS tm, positive - negative AS tg, overlay - clean AS od,
      0.01 - (overlay - clean) AS og, coalesce(overlay - clean > 0.01, false) OR flagged AS of_,
      coalesce(positive < 0.0025, false) AS tf, coalesce(positive <= negative, false) AS nf
      FROM decisions""",
    "k": """SELECT *, NOT of_ AND coalesce(positive >= 0.0025 AND positive > negative, false) AS kr FROM m""",
    "dist": """SELECT *, CASE WHEN kr THEN least(tm, tg, og)
       ELSE greatest(CASE WHEN of_ THEN -og END, CASE WHEN tf THEN -tm END, CASE WHEN nf THEN -tg END) END AS dd
       FROM k""",
    "margins": """SELECT image, kept, reason, round(tm,6) AS target_margin, round(tg,6) AS target_gap,
      round(od,6) AS overlay_delta, round(og,6) AS overlay_margin_gap, of_ AS overlay_fail,
      tf AS threshold_fail, nf AS negative_fail, kr AS kept_by_rule,
      CASE WHEN of_ THEN 'overlay_margin'
           WHEN tf AND nf THEN CASE WHEN negative - positive >= 0.0025 - positive
                THEN 'target_vs_negative' ELSE 'target_threshold' END
           WHEN tf THEN 'target_threshold' WHEN nf THEN 'target_vs_negative'
           ELSE 'unknown' END AS rejection_mode,
      CASE WHEN kr THEN CASE WHEN dd=tm THEN 'target_threshold' WHEN dd=tg THEN 'target_vs_negative'
                             ELSE 'overlay_margin' END
           WHEN dd IS NULL THEN 'unknown'
           WHEN of_ AND dd=-og THEN 'overlay_margin' WHEN tf AND dd=-tm THEN 'target_threshold'
           ELSE 'target_vs_negative' END AS nearest_boundary,
      round(dd,6) AS decision_distance,
      CASE WHEN dd IS NULL THEN 'unknown' WHEN dd<0.03 THEN 'borderline' WHEN dd<0.08 THEN 'moderate'
           ELSE 'clear' END AS decision_band FROM dist""",
}


def margins(spark, sf_dir):
    return scoring.margin_analysis(I.decisions(spark, sf_dir), I.THRESHOLDS)


@register("margin_analysis", I.sql("SELECT * FROM margins", "decisions", extra=MARGINS))
def margin_analysis(spark, sf_dir):
    out = margins(spark, sf_dir).drop("positive", "negative", "overlay", "clean", "flagged")
    for name in (
        "target_margin", "target_gap", "overlay_delta", "overlay_margin_gap", "decision_distance"
    ):
        out = out.withColumn(name, F.round(name, 6))
    return out


@register(
    "rejection_reasons",
    I.sql(
        """SELECT image, CASE WHEN reason='overlay' THEN 'overlay' ELSE 'low_score' END AS rejection_reason,
        positive, negative, overlay, clean, flagged FROM decisions WHERE NOT kept""",
        "decisions",
    ),
)
def rejection_reasons(spark, sf_dir):
    return scoring.rejection_reasons(I.decisions(spark, sf_dir))
