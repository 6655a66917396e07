"""Curation tables derived from the test tables, in Spark and in SQL.

There are no images among the test tables, so items, prompts, hashes and
annotations are derived from ``embeddings`` and the others by plain expressions
over all their rows. ``sql(...)`` gives the same tables as common table
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_curate.functions import vectors as V
from spark_curate.operators import labeling, scoring

THRESHOLDS = scoring.Thresholds(threshold=0.0025, overlay_margin=0.01)
CATEGORIES = ("grain", "hue")
DUP_BITS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def item_name(key: Column) -> Column:
    source = (
        F.when(key % 3 == 0, F.lit("Image")).when(key % 3 == 1, F.lit("google")).otherwise("flickr")
    )
    return F.concat(
        F.substring(F.md5((key % 7).cast("string")), 1, 8),
        F.lit("_"),
        source,
        F.lit("_"),
        F.lpad(key.cast("string"), 12, "0"),
        F.lit(".jpg"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        item_name(F.col("vec_id")).alias("image"), "vec_id", "label", "embedding"
    )


def group_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each class stands for a prompt of two groups: its mean vector."""
    label = F.col("label")
    classes = table(spark, sf_dir, "embeddings").groupBy("label").agg(
        V.mean_vector(F.col("embedding")).alias("embedding")
    )
    pair = F.array(
        F.when(label < 5, F.lit("positive")).otherwise("negative"),
        F.when(label % 2 == 1, F.lit("overlay")).otherwise("clean"),
    )
    return classes.select(F.explode(pair).alias("group"), label.alias("prompt_ord"), "embedding")


def label_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two categories of five labels, three prompts each."""
    base = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") % 3).alias("prompt_ord"),
        F.explode(
            F.array(
                F.struct(F.lit("hue").alias("category"), (F.col("label") % 5).alias("label_ord")),
                F.struct(
                    F.lit("grain").alias("category"),
                    F.floor(F.col("label") / 2).cast("int").alias("label_ord"),
                ),
            )
        ).alias("k"),
        "embedding",
    )
    return (
        base.groupBy("k", "prompt_ord")
        .agg(V.mean_vector(F.col("embedding")).alias("embedding"))
        .select(
            "k.category",
            F.concat(F.substring("k.category", 1, 1), F.col("k.label_ord").cast("string")).alias(
                "label"
            ),
            "k.label_ord",
            "prompt_ord",
            "embedding",
        )
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.group_scores(items(spark, sf_dir), group_prompts(spark, sf_dir))
    return scored.select(
        "image", "label", *[F.round(g, 6).alias(g) for g in scoring.GROUPS]
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.filter_decisions(scores(spark, sf_dir), THRESHOLDS)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labeling.label_records(items(spark, sf_dir), label_prompts(spark, sf_dir))


def truth(label: Column) -> Column:
    return F.create_map(
        F.lit("grain"),
        F.concat(F.lit("g"), F.floor(label / 2).cast("int").cast("string")),
        F.lit("hue"),
        F.concat(F.lit("h"), (label % 5).cast("string")),
    )


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation sample of all items: kept ones carry predictions.

    Classes 0-6 are on target, 7 and 8 are not, class 9 is not annotated yet.
    """
    scored = scoring.group_scores(items(spark, sf_dir), group_prompts(spark, sf_dir))
    carried = ["label", "embedding"]
    decided = scoring.filter_decisions(
        scored.select("image", *carried, *[F.round(g, 6).alias(g) for g in scoring.GROUPS]),
        THRESHOLDS,
        keep=carried,
    )
    labelled = labeling.label_records(decided, label_prompts(spark, sf_dir), keep=["label", "kept"])
    label, accepted = F.col("label"), F.col("kept")
    return labelled.select(
        "image",
        F.when(accepted, F.lit("accepted")).otherwise("rejected").alias("source"),
        F.when(accepted, F.col("predicted")).alias("predicted"),
        F.when(
            accepted, F.transform_values("scores", lambda _, r: r["confidence"])
        ).alias("confidence"),
        F.when(label < 7, truth(label)).alias("ground_truth"),
        F.when(label == 9, F.lit(None)).otherwise(label < 7).cast("boolean").alias("is_target"),
    )


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 sign bits of a vector as a hash; order key is the name.

    Every fourth item is a second shot of the one before it: nine parts of that vector
    and one of its own, which turns a few signs. So near duplicates exist.
    """
    before = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") + 1).alias("vec_id"), V.doubles(F.col("embedding")).alias("_before")
    )
    shot = (F.col("vec_id") % 4 == 3) & F.col("_before").isNotNull()
    own = V.doubles(F.col("embedding"))
    mixed = F.when(shot, F.zip_with("_before", own, lambda a, b: a * 9 + b)).otherwise(own)
    bits = F.aggregate(
        F.transform(
            "_vector",
            lambda x, i: F.when(x >= 0, _bit(i)).otherwise(F.lit(0).cast("bigint")),
        ),
        F.lit(0).cast("bigint"),
        lambda a, b: a.bitwiseOR(b),
    )
    shots = items(spark, sf_dir).join(before, "vec_id", "left").select("image", mixed.alias("_vector"))
    return shots.select("image", bits.alias("phash"))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


# Common table expressions with the same content, by name.
CTES: dict[str, str] = {
    "items": """SELECT substr(md5((vec_id%7)::VARCHAR),1,8) || '_' ||
    CASE vec_id%3 WHEN 0 THEN 'Image' WHEN 1 THEN 'google' ELSE 'flickr' END || '_' ||
    lpad(vec_id::VARCHAR, 12, '0') || '.jpg' AS image, vec_id, label,
    embedding::DOUBLE[] AS embedding FROM embeddings""",
    "dims": """SELECT label, vec_id%3 AS p, i,
    sum(v::DOUBLE) AS s, count(*) AS n
    FROM (SELECT label, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i
          FROM embeddings) GROUP BY ALL""",
    "class_dims": "SELECT label, i, sum(s)/sum(n) AS v FROM dims GROUP BY ALL",
    "group_dims": """SELECT g, i, avg(v) AS v FROM (
      SELECT CASE WHEN label<5 THEN 'positive' ELSE 'negative' END AS g, i, v FROM class_dims
      UNION ALL
      SELECT CASE WHEN label%2=1 THEN 'overlay' ELSE 'clean' END, i, v FROM class_dims) GROUP BY ALL""",
    "group_vecs": "SELECT g, list(v ORDER BY i) AS vec FROM group_dims GROUP BY g",
    "label_dims": """SELECT category, label_ord, i, avg(v) AS v FROM (
      SELECT category, label_ord, p, i, sum(s)/sum(n) AS v FROM (
        SELECT 'hue' AS category, label%5 AS label_ord, p, i, s, n FROM dims
        UNION ALL SELECT 'grain', label//2, p, i, s, n FROM dims) GROUP BY ALL) GROUP BY ALL""",
    "label_vecs": """SELECT category, label_ord, substr(category,1,1) || label_ord::VARCHAR AS label,
      list(v ORDER BY i) AS vec FROM label_dims GROUP BY category, label_ord""",
    "scores": """SELECT image, label,
      max(CASE WHEN g='positive' THEN s END) AS positive, max(CASE WHEN g='negative' THEN s END) AS negative,
      max(CASE WHEN g='overlay' THEN s END) AS overlay, max(CASE WHEN g='clean' THEN s END) AS clean
      FROM (SELECT image, label, g, round(list_dot_product(embedding, vec), 6) + 0.0 AS s
            FROM items, group_vecs) GROUP BY image, label""",
    "reasons": """SELECT *, overlay - clean > 0.01 AS flagged,
      CASE WHEN overlay - clean > 0.01 THEN 'overlay'
           WHEN positive >= 0.0025 AND positive > negative THEN 'passed' ELSE 'low_score' END AS reason
      FROM scores""",
    "decisions": """SELECT image, CASE WHEN reason='overlay' THEN NULL ELSE positive END AS positive,
      CASE WHEN reason='overlay' THEN NULL ELSE negative END AS negative, overlay, clean, flagged,
      reason='passed' AS kept, reason FROM reasons""",
    "label_scores": """SELECT image, category, v.label AS label, label_ord,
      list_dot_product(embedding, vec) AS score FROM items, label_vecs v""",
    "ranked": """SELECT image, category, label, round(score, 4) + 0.0 AS score,
      row_number() OVER (PARTITION BY image, category ORDER BY round(score, 4) DESC, label_ord) AS rn
      FROM label_scores""",
    "labels_out": """SELECT image, category, max(CASE WHEN rn=1 THEN label END) AS assigned,
      max(CASE WHEN rn=1 THEN score END) AS confidence, max(CASE WHEN rn=2 THEN label END) AS runner_up,
      max(CASE WHEN rn=2 THEN score END) AS runner_up_score FROM ranked GROUP BY image, category""",
    "marks": """SELECT i.image, kept, CASE WHEN kept THEN 'accepted' ELSE 'rejected' END AS source,
      CASE WHEN label=9 THEN NULL ELSE label<7 END AS is_target,
      CASE WHEN label<7 THEN 'h' || (label%5)::VARCHAR END AS gt_hue,
      CASE WHEN label<7 THEN 'g' || (label//2)::VARCHAR END AS gt_grain
      FROM items i JOIN decisions d ON i.image=d.image""",
    "evaluated": """SELECT m.image, l.category, l.assigned AS pred, l.confidence AS conf,
      CASE l.category WHEN 'hue' THEN gt_hue ELSE gt_grain END AS gt
      FROM marks m JOIN labels_out l ON m.image=l.image WHERE m.kept AND m.is_target""",
    "shots": """SELECT i.image, CASE WHEN i.vec_id % 4 = 3 AND p.image IS NOT NULL
        THEN list_transform(list_zip(p.embedding, i.embedding), lambda z: z[1] * 9 + z[2])
        ELSE i.embedding END AS vector FROM items i LEFT JOIN items p ON p.vec_id = i.vec_id - 1""",
    "hashes": """SELECT image, list_reduce(list_transform(vector, lambda x, i:
        CASE WHEN x < 0 THEN 0 WHEN i=64 THEN (-9223372036854775808)::BIGINT
             ELSE (1::BIGINT << (i-1)::BIGINT) END), lambda a, b: a | b) AS phash FROM shots""",
}

_NEEDS: dict[str, tuple[str, ...]] = {
    "class_dims": ("dims",),
    "group_dims": ("class_dims",),
    "group_vecs": ("group_dims",),
    "label_dims": ("dims",),
    "label_vecs": ("label_dims",),
    "scores": ("items", "group_vecs"),
    "reasons": ("scores",),
    "decisions": ("reasons",),
    "label_scores": ("items", "label_vecs"),
    "ranked": ("label_scores",),
    "labels_out": ("ranked",),
    "marks": ("items", "decisions"),
    "evaluated": ("marks", "labels_out"),
    "shots": ("items",),
    "hashes": ("shots",),
}


def sql(body: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``body`` preceded by the named expressions and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in ordered]
    parts += [f"{n} AS ({text})" for n, text in (extra or {}).items()]
    head = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} " if parts else ""
    return head + body
