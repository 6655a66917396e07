"""Evaluation samples, annotation merge and accuracy metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.functions import names as N

# Confidence bins (label, lower, upper), half open.
CALIBRATION_BINS = (
    ("<0.20", 0.0, 0.20),
    ("0.20-0.22", 0.20, 0.22),
    ("0.22-0.24", 0.22, 0.24),
    ("0.24-0.26", 0.24, 0.26),
    ("0.26-0.28", 0.26, 0.28),
    ("0.28-0.30", 0.28, 0.30),
    (">0.30", 0.30, 1.0),
)


def draw(names: DataFrame, n: int, seed: int, key: str = "image") -> DataFrame:
    """Exactly ``min(n, rows)`` rows in a seeded pseudo-random order.

    The order depends only on seed and key, so the draw is the same for every
    partitioning and can be repeated in any SQL engine.
    """
    order = F.md5(F.concat(F.lit(str(seed)), F.col(key)))
    return names.orderBy(order, key).limit(n)


def eval_sample(
    records: DataFrame,
    rejected: DataFrame,
    categories: Sequence[str],
    n_accepted: int = 100,
    n_rejected: int = 30,
    seed: int = 42,
) -> DataFrame:
    """Sample of accepted records and rejected names, ready for annotation."""
    predicted = C.map_from_columns(
        (c, C.lookup(F.col("predicted"), c, C.UNKNOWN)) for c in categories
    )
    confidence = F.transform_values(
        F.map_filter("scores", lambda k, _: k.isin(*categories)), lambda _, r: r["confidence"]
    )
    empty = F.lit(None)
    tail = [
        empty.cast("map<string,string>").alias("ground_truth"),
        empty.cast("boolean").alias("is_target"),
    ]
    taken = draw(records, n_accepted, seed).select(
        "image",
        F.lit("accepted").alias("source"),
        predicted.alias("predicted"),
        confidence.alias("confidence"),
        *tail,
    )
    left_out = draw(rejected.select("image").distinct(), n_rejected, seed).select(
        "image",
        F.lit("rejected").alias("source"),
        empty.cast("map<string,string>").alias("predicted"),
        empty.cast("map<string,double>").alias("confidence"),
        *tail,
    )
    return taken.unionByName(left_out)


def rejected_names(log: DataFrame) -> DataFrame:
    """Distinct non-blank names of a decision log that are not kept."""
    name = F.trim("filename")
    return log.where((name != "") & ~C.is_true_text(F.col("kept"))).select(name.alias("image")).distinct()


def rejected_by_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Names whose stem is in ``before`` but not in ``after`` (columns ``image``).

    Where several files share the stem, the preferred suffix is taken.
    """
    order = F.array_position(F.array(*[F.lit(s) for s in N.LISTED_SUFFIXES]), N.suffix(F.col("image")))
    listed = N.is_image(F.col("image"), N.LISTED_SUFFIXES)
    left = before.where(listed).withColumn("stem", N.stem(F.col("image")))
    right = after.where(listed).select(N.stem(F.col("image")).alias("stem"))
    return (
        left.join(right, "stem", "left_anti")
        .groupBy("stem")
        .agg(F.min_by("image", F.struct(order, "image")).alias("image"))
        .select("image")
    )


def is_annotated() -> Column:
    return F.col("is_target").isNotNull()


def is_confirmed() -> Column:
    """On target with ground truth."""
    return (
        F.col("is_target").eqNullSafe(True)
        & F.col("ground_truth").isNotNull()
        & (F.size("ground_truth") > 0)
    )


def has_predictions() -> Column:
    return F.col("predicted").isNotNull() & (F.size("predicted") > 0)


def sample_sizes(sample: DataFrame) -> DataFrame:
    """The six counters of a sample in one row."""
    accepted, rejected = F.col("source") == "accepted", F.col("source") == "rejected"
    confirmed = is_confirmed()
    return sample.agg(
        F.count_if(is_annotated() & (accepted | rejected)).alias("total_annotated"),
        F.count_if(is_annotated() & accepted).alias("accepted_annotated"),
        F.count_if(is_annotated() & rejected).alias("rejected_annotated"),
        F.count_if(confirmed).alias("target_confirmed"),
        F.count_if(confirmed & has_predictions()).alias("target_confirmed_with_predictions"),
        F.count_if(confirmed & ~has_predictions()).alias("target_confirmed_without_predictions"),
    )


def annotation_progress(sample: DataFrame) -> DataFrame:
    return sample.agg(F.count("is_target").alias("annotated"), F.count("*").alias("total"))


def filter_metrics(sample: DataFrame) -> DataFrame:
    """Confusion counts, precision, recall and F1 of the filter in one row.

    Recall is null without annotated rejected rows or without true targets; F1
    is null where recall is, and where precision and recall are both 0.
    """
    annotated = sample.where(is_annotated())
    accepted, rejected = F.col("source") == "accepted", F.col("source") == "rejected"
    hit = F.col("is_target")
    counts = annotated.agg(
        F.count_if(accepted & hit).alias("true_positives"),
        F.count_if(accepted & ~hit).alias("false_positives"),
        F.count_if(rejected & hit).alias("false_negatives"),
        F.count_if(rejected & ~hit).alias("true_negatives"),
        F.count_if(accepted).alias("accepted_evaluated"),
        F.count_if(rejected).alias("rejected_evaluated"),
    )
    precision = F.coalesce(C.ratio(F.col("true_positives"), F.col("accepted_evaluated")), F.lit(0.0))
    recall = F.when(
        F.col("rejected_evaluated") > 0,
        C.ratio(F.col("true_positives"), F.col("true_positives") + F.col("false_negatives")),
    )
    both = counts.select("*", precision.alias("_p"), recall.alias("_r"))
    f1 = C.ratio(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r"))
    return both.select(
        *counts.columns,
        F.round("_p", 4).alias("precision"),
        F.round("_r", 4).alias("recall"),
        F.round(f1, 4).alias("f1"),
    )


def comparisons(sample: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """(image, category, predicted, truth, confidence) of confirmed samples."""
    ready = sample.where(is_confirmed() & has_predictions())
    pairs = C.unnest(
        ready, ["image", "predicted", "confidence"], F.col("ground_truth"), "category", "truth"
    )
    if categories is not None:
        pairs = pairs.where(F.col("category").isin(*categories))
    return pairs.select(
        "image",
        "category",
        C.lookup(F.col("predicted"), F.col("category")).alias("predicted"),
        "truth",
        C.lookup(F.col("confidence"), F.col("category")).alias("confidence"),
    ).where(F.col("predicted").isNotNull() & F.col("truth").isNotNull())


def label_accuracy(compared: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Accuracy per category; 0 for a given category without comparisons."""
    counts = compared.groupBy("category").agg(
        F.count_if(F.col("predicted") == F.col("truth")).alias("correct"),
        F.count("*").alias("total"),
    )
    if categories is not None:
        skeleton = compared.sparkSession.createDataFrame([(c,) for c in categories], "category string")
        counts = skeleton.join(counts, "category", "left").fillna(0, ["correct", "total"])
    return counts.select(
        "category",
        F.round(F.coalesce(C.ratio(F.col("correct"), F.col("total")), F.lit(0.0)), 4).alias("accuracy"),
        "correct",
        "total",
    )


def confusion(compared: DataFrame) -> DataFrame:
    """Count per (category, truth, predicted)."""
    return compared.groupBy("category", "truth", "predicted").agg(F.count("*").alias("n"))


def vocabulary(confused: DataFrame) -> DataFrame:
    """Labels seen as truth or prediction, per category."""
    return confused.select(
        "category", F.explode(F.array("truth", "predicted")).alias("label")
    ).distinct()


def confusion_dense(confused: DataFrame) -> DataFrame:
    """Full label grid per category with zeros and intensity n / max(n).

    The vocabulary of a category is bounded by its prompts, so the grid is made
    from one array per category instead of a join of labels with labels.
    """
    labels = vocabulary(confused).groupBy("category").agg(F.sort_array(F.collect_set("label")).alias("v"))
    grid = labels.select("category", "v", F.explode("v").alias("truth")).select(
        "category", "truth", F.explode("v").alias("predicted")
    )
    filled = grid.join(confused, ["category", "truth", "predicted"], "left").fillna(0, ["n"])
    top = F.max("n").over(Window.partitionBy("category"))
    return filled.select(
        "category",
        "truth",
        "predicted",
        "n",
        F.coalesce(C.ratio(F.col("n"), top), F.lit(0.0)).alias("intensity"),
    )


def per_label_metrics(confused: DataFrame) -> DataFrame:
    """Precision, recall and support per label over the whole vocabulary."""
    same = F.col("truth") == F.col("predicted")
    # Each count serves its truth and its predicted label: one shuffle.
    sides = confused.select(
        "category",
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p")),
            )
        ).alias("s"),
        F.when(same, F.col("n")).otherwise(0).alias("hits"),
    )
    totals = sides.groupBy("category", "s.label").agg(
        F.sum("s.t").alias("support"),
        F.sum("s.p").alias("_predicted"),
        F.sum(F.when(F.col("s.t") > 0, F.col("hits")).otherwise(0)).alias("_hits"),
    )
    zero = F.lit(0.0)
    return totals.select(
        "category",
        "label",
        F.round(F.coalesce(C.ratio(F.col("_hits"), F.col("_predicted")), zero), 4).alias("precision"),
        F.round(F.coalesce(C.ratio(F.col("_hits"), F.col("support")), zero), 4).alias("recall"),
        "support",
    )


def calibration(compared: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Accuracy and count per category and confidence bin; empty bins appear.

    Bins are half open: 1.0 and negative confidences fall in none.
    """
    conf = F.col("confidence")
    bin_index = F.coalesce(
        *[
            F.when((conf >= low) & (conf < high), F.lit(i))
            for i, (_, low, high) in enumerate(CALIBRATION_BINS)
        ]
    )
    counts = (
        compared.where(conf.isNotNull())
        .groupBy("category", bin_index.alias("bin_ord"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("predicted") == F.col("truth")).alias("correct"),
        )
    )
    skeleton = compared.sparkSession.createDataFrame(
        [(c, i, b[0]) for c in categories for i, b in enumerate(CALIBRATION_BINS)],
        "category string, bin_ord int, bin string",
    )
    return (
        skeleton.join(counts, ["category", "bin_ord"], "left")
        .fillna(0, ["n", "correct"])
        .select(
            "category",
            "bin_ord",
            "bin",
            F.round(C.ratio(F.col("correct"), F.col("n")), 4).alias("accuracy"),
            "n",
        )
    )


def calibration_grid(calibrated: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Bins by categories with cells such as ``83.3% (n=12)``."""
    cell = F.when(F.col("accuracy").isNull(), F.lit("—")).otherwise(
        F.concat(C.percent_text(F.col("accuracy")), F.lit(" (n="), F.col("n").cast("string"), F.lit(")"))
    )
    return (
        calibrated.withColumn("cell", cell)
        .groupBy("bin_ord", "bin")
        .pivot("category", list(categories))
        .agg(F.first("cell"))
    )


def category_ranking(accuracy: DataFrame) -> DataFrame:
    return accuracy.orderBy(F.col("accuracy").desc(), "category")


def summary(accuracy: DataFrame, filtered: DataFrame) -> DataFrame:
    """Mean of the rounded category accuracies next to precision and recall."""
    overall = accuracy.agg(F.round(F.avg("accuracy"), 4).alias("overall_label_accuracy"))
    # Both sides are a single aggregate row.
    return overall.withColumn("_one", F.lit(1)).join(
        filtered.select(
            F.lit(1).alias("_one"),
            F.col("precision").alias("filter_precision"),
            F.col("recall").alias("filter_recall"),
        ),
        "_one",
    ).drop("_one")


def report_tables(sample: DataFrame, categories: Sequence[str]) -> dict[str, DataFrame]:
    """Every table of the evaluation report."""
    compared = comparisons(sample, categories)
    confused = confusion(compared)
    accuracy = label_accuracy(compared, categories)
    filtered = filter_metrics(sample)
    calibrated = calibration(compared, categories)
    return {
        "filter": filtered,
        "sample_size": sample_sizes(sample),
        "summary": summary(accuracy, filtered),
        "labels": category_ranking(accuracy),
        "per_label": per_label_metrics(confused).orderBy("category", "label"),
        "confusion": confused,
        "confusion_dense": confusion_dense(confused),
        "calibration": calibrated,
        "calibration_grid": calibration_grid(calibrated, categories).orderBy("bin_ord"),
    }


def match_status(sample: DataFrame) -> DataFrame:
    """not_target, match, mismatch or unlabelled for each sample row."""
    agrees = F.forall(
        F.map_entries("ground_truth"),
        lambda e: C.lookup(F.col("predicted"), e["key"]).eqNullSafe(e["value"]),
    )
    labelled = F.col("ground_truth").isNotNull() & F.col("predicted").isNotNull()
    return sample.select(
        "image",
        F.when(F.col("is_target").eqNullSafe(False), "not_target")
        .when(~labelled, "unlabelled")
        .when(agrees, "match")
        .otherwise("mismatch")
        .alias("status"),
    )


def browse_predicate(
    target: str = "", category: str = "", correct: str = ""
) -> Column:
    """Filter of the sample browser.

    ``target``: ``target`` or ``not_target``; ``correct``: ``correct`` or
    ``incorrect``. Rows without the data a filter needs pass it.
    """
    rejected = F.col("is_target").eqNullSafe(False)
    truth = F.coalesce("ground_truth", F.create_map().cast("map<string,string>"))
    guess = F.coalesce("predicted", F.create_map().cast("map<string,string>"))
    has_truth, has_guess = F.size(truth) > 0, F.size(guess) > 0
    keep = F.lit(True)
    if target == "target":
        keep = keep & ~rejected
    elif target == "not_target":
        keep = keep & rejected
    if category:
        keep = keep & (~has_truth | F.map_contains_key(truth, category))
    if correct:
        if category:
            right = C.lookup(guess, category).eqNullSafe(C.lookup(truth, category))
            any_shared = F.lit(True)
        else:
            shared = F.filter(F.map_entries(truth), lambda e: F.map_contains_key(guess, e["key"]))
            right = F.forall(shared, lambda e: C.lookup(guess, e["key"]).eqNullSafe(e["value"]))
            any_shared = F.size(shared) > 0
        wanted = (right & any_shared) if correct == "correct" else ~right
        keep = keep & (~(has_truth & has_guess) | wanted)
    return keep


def latest_events(events: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last event of each key; combined map-side, so a hot key costs no more."""
    rest = [c for c in events.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return events.groupBy(key).agg(last.alias("_e")).select(key, "_e.*")


def valid_labels(annotations: DataFrame, options: DataFrame) -> DataFrame:
    """Long annotation labels restricted to the allowed (category, label) pairs."""
    given = annotations.select("image", F.explode("labels").alias("category", "_l")).select(
        "image", "category", F.trim("_l").alias("label")
    )
    allowed = options.select("category", "label").distinct()
    return given.join(allowed, ["category", "label"], "left_semi").select("image", "category", "label")


SMALL_OPTIONS = 100_000


def label_options(options: DataFrame, small_rows: int = SMALL_OPTIONS) -> DataFrame:
    """Distinct (category, label) pairs, sent to the rows if there are few, else joined."""
    allowed = options.select("category", "label").where("category is not null and label is not null").distinct()
    return F.broadcast(allowed) if allowed.limit(small_rows + 1).count() <= small_rows else allowed


def resolve_ground_truth(joined: DataFrame, options: DataFrame, small_rows: int = SMALL_OPTIONS) -> DataFrame:
    """Resolve annotated rows (columns predicted, labels, is_target).

    A valid user label overrides a valid prediction; which labels are valid comes from
    joins with ``options``, whatever its size. Adds ``ground_truth`` and ``missing``
    (categories left without a label; such a row is refused). A row not marked as
    target loses its ground truth.
    """
    categories = [r[0] for r in options.select("category").where("category is not null").distinct().sort("category").collect()]
    allowed = label_options(options, small_rows)
    judged = joined
    for k, category in enumerate(categories):
        for column, source in ((f"_given{k}", "labels"), (f"_guess{k}", "predicted")):
            valid = allowed.where(F.col("category") == category).select(F.col("label").alias(column))
            judged = judged.withColumn("_said", F.trim(C.lookup(F.col(source), category)))
            judged = judged.join(valid, F.col("_said") == F.col(column), "left").drop("_said")
    resolved = [F.coalesce(f"_given{k}", f"_guess{k}") for k in range(len(categories))]
    hit = F.col("is_target").eqNullSafe(True)
    none = F.array().cast("array<string>")
    lacking = F.array_compact(
        F.array(*[F.when(r.isNull(), F.lit(c)) for c, r in zip(categories, resolved)]).cast("array<string>")
    )
    full = C.map_from_columns((c, r) for c, r in zip(categories, resolved))
    return (
        judged.withColumn("missing", F.when(hit, lacking).otherwise(none))
        .withColumn("ground_truth", F.when(hit & (F.size("missing") == 0), full))
        .select(*[c for c in joined.columns if c not in ("missing", "ground_truth")], "missing", "ground_truth")
    )


def apply_annotations(
    sample: DataFrame, annotations: DataFrame, options: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Apply the last accepted event of each image.

    Returns (sample, refused). Refused events are those lacking a category or
    naming an unknown image; they change nothing.
    """
    known = sample.select("image", "predicted", F.lit(True).alias("_known"))
    joined = annotations.join(known, "image", "left")
    judged = resolve_ground_truth(joined, options)
    ok = F.col("_known").isNotNull() & (F.size("missing") == 0)
    last = latest_events(
        judged.where(ok).select("image", "is_target", "ground_truth", "ts", "event_id"),
        "image",
        ("ts", "event_id"),
    ).select(
        "image",
        F.struct("is_target", "ground_truth").alias("_new"),
    )
    merged = sample.join(last, "image", "left")
    changed = F.col("_new").isNotNull()
    result = merged.select(
        "image",
        "source",
        "predicted",
        "confidence",
        F.when(changed, F.col("_new.ground_truth")).otherwise(F.col("ground_truth")).alias("ground_truth"),
        F.when(changed, F.col("_new.is_target")).otherwise(F.col("is_target")).alias("is_target"),
    )
    refused = judged.where(~ok).select(
        "image",
        "event_id",
        F.when(F.col("_known").isNull(), "unknown_image").otherwise("missing_labels").alias("error"),
        "missing",
    )
    return result, refused
