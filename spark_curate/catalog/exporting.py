"""Queries on logs, exports, manifests, settings and the composed steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_curate.catalog import collecting, filtering
from spark_curate.catalog import inputs as I
from spark_curate.catalog.deduping import greedy_sql
from spark_curate.functions import columns as C
from spark_curate.functions import names as N
from spark_curate.functions import vectors as V
from spark_curate.functions.session import materialize
from spark_curate.operators import evaluation, export, labeling, manifest, resolution, scoring
from spark_curate.plans import steps
from spark_curate.sources import readers, writers
from spark_curate.sources import schemas as S

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


# Logs

LOG_SQL = """SELECT image AS filename, CASE WHEN positive IS NULL THEN 'N/A' ELSE printf('%.4f', positive) END AS positive_score,
  CASE WHEN negative IS NULL THEN 'N/A' ELSE printf('%.4f', negative) END AS negative_score,
  CASE WHEN reason='overlay' THEN 'overlay' WHEN kept THEN 'True' ELSE 'False' END AS kept FROM decisions"""


@register(
    "kept_names",
    I.sql("SELECT image FROM decisions WHERE kept", "decisions"),
)
def kept_names(spark, sf_dir):
    return readers.kept_names(writers.target_log_rows(I.decisions(spark, sf_dir)))


@register(
    "rejected_names",
    I.sql("SELECT image FROM decisions WHERE NOT kept", "decisions"),
)
def rejected_names(spark, sf_dir):
    return evaluation.rejected_names(writers.target_log_rows(I.decisions(spark, sf_dir)))


@register(
    "log_states",
    I.sql(f"SELECT kept, count(*) AS n FROM ({LOG_SQL}) GROUP BY kept", "decisions"),
)
def log_states(spark, sf_dir):
    rows = writers.target_log_rows(I.decisions(spark, sf_dir))
    return rows.groupBy("kept").agg(F.count("*").alias("n"))


@register(
    "rejected_stems",
    I.sql(
        """SELECT file AS image FROM (SELECT file, regexp_replace(file, '\\.[^.]+$', '') AS stem,
        row_number() OVER (PARTITION BY regexp_replace(file, '\\.[^.]+$', '') ORDER BY suffix, file) AS rn
        FROM (SELECT DISTINCT file, suffix FROM named WHERE suffix IN ('jpg','png','webp'))) WHERE rn = 1
        AND stem NOT IN (SELECT regexp_replace(file, '\\.[^.]+$', '') FROM steps WHERE status='kept' AND suffix IN ('jpg','png','webp'))""",
        extra=collecting.NAMES,
    ),
)
def rejected_stems(spark, sf_dir):

    raw = collecting.raw_files(spark, sf_dir)
    passed = resolution.resolution_step(raw).where(F.col("status") == "kept")
    before = raw.select(N.file_name(F.col("path")).alias("image")).distinct()
    after = passed.select(N.file_name(F.col("path")).alias("image"))
    return evaluation.rejected_by_difference(before, after)


@register(
    "listing",
    I.sql(
        """SELECT 'stored' AS step, image FROM items UNION ALL SELECT 'filter', image FROM decisions WHERE kept
        UNION ALL SELECT DISTINCT 'label', image FROM labels_out""",
        "items", "decisions", "labels_out",
    ),
)
def listing(spark, sf_dir):
    """Steps that stored files list those; others the kept names of their log or their labels."""
    everything, decided = I.items(spark, sf_dir), I.decisions(spark, sf_dir)
    none = everything.where(F.lit(False))
    padded = I.records(spark, sf_dir).withColumn("image", F.concat(F.lit(" "), F.col("image"), F.lit(" ")))
    steps = {
        "stored": readers.listing(everything, log=decided),
        "filter": readers.listing(none, log=decided),
        "label": readers.listing(none, labels=padded),
    }
    named = [names.select(F.lit(step).alias("step"), "image") for step, names in steps.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@register(
    "effective_thresholds",
    I.sql(
        """SELECT round(value / 1000, 6) AS threshold, 0.07::DOUBLE AS overlay_margin, 'run_metadata' AS source, event_id AS generated_at
        FROM events WHERE event_type='signup' ORDER BY event_id DESC LIMIT 1"""
    ),
)
def effective_thresholds(spark, sf_dir):
    """Each signup event records a run that set the target threshold only."""
    runs = I.table(spark, sf_dir, "events").where(F.col("event_type") == "signup").select(
        F.round(F.col("value") / 1000, 6).cast("string").alias("target_threshold"),
        F.lit("n/a").alias("overlay_margin"),
        F.col("event_id").alias("generated_at"),
    )
    return readers.effective_thresholds(runs, scoring.Thresholds())


@register(
    "tolerant_numbers",
    I.sql(
        """SELECT doc_id, CASE WHEN doc_id%5=0 THEN NULL WHEN doc_id%5=1 THEN n_chars / 4 ELSE NULL END AS value FROM documents""",
    ),
)
def tolerant_numbers(spark, sf_dir):
    k = F.col("doc_id") % 5
    text = (
        F.when(k == 0, " N/A ")
        .when(k == 1, F.concat(F.lit(" "), (F.col("n_chars") / 4).cast("string")))
        .when(k == 2, "")
        .when(k == 3, "none")
        .otherwise("12,5 px")
    )
    return I.table(spark, sf_dir, "documents").select(
        "doc_id", C.tolerant_double(text).alias("value")
    )


@register(
    "display_texts",
    I.sql(
        """SELECT o_orderstatus || '_' || lower(o_orderpriority) AS key, count(*) AS n, format('{:,}', count(*)) AS shown,
        printf('%.1f%%', count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()) AS share FROM orders GROUP BY 1"""
    ),
)
def display_texts(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    key = F.concat("o_orderstatus", F.lit("_"), F.lower("o_orderpriority"))
    counts = orders.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    total = orders.count()
    return counts.select(
        "key",
        "n",
        C.thousands(F.col("n")).alias("shown"),
        C.percent_text(F.col("n") / total).alias("share"),
    )


@register(
    "vector_maths",
    I.sql(
        """SELECT image, round(sqrt(list_dot_product(embedding, embedding)), 6) AS length,
        round(list_dot_product(embedding, vec) / sqrt(list_dot_product(vec, vec)), 6) AS cosine,
        round(list_distance(embedding, vec), 6) AS distance FROM items i JOIN class_vecs c ON c.label = i.label""",
        "items", "class_dims",
        extra={"class_vecs": "SELECT label, list(v ORDER BY i) AS vec FROM class_dims GROUP BY label"},
    ),
)
def vector_maths(spark, sf_dir):
    everything = I.items(spark, sf_dir)
    means = everything.groupBy("label").agg(V.mean_vector(F.col("embedding")).alias("mean"))
    mean, vector = F.col("mean"), F.col("embedding")
    return everything.join(means, "label").select(
        "image",
        F.round(V.norm(vector), 6).alias("length"),
        F.round(V.dot(vector, V.unit(mean)), 6).alias("cosine"),
        F.round(V.euclidean(vector, mean), 6).alias("distance"),
    )


# Export


def wide(spark, sf_dir):
    return writers.wide_labels(I.records(spark, sf_dir), I.CATEGORIES, scores=False)


def corrections(spark, sf_dir):
    """Error events correct the hue, and every other one the grain too."""
    event = F.col("event_id")
    events = I.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("vec_id"),
        F.when(F.col("event_type") == "error", F.lit(False))
        .when(F.col("event_type") == "click", F.lit(True)).alias("correct"),
        event.alias("ord"),
        F.concat(F.lit("h"), (event % 5).cast("string")).alias("hue"),
        F.when(event % 2 == 0, F.concat(F.lit("g"), (event % 4).cast("string"))).alias("grain"),
    )
    return events.join(I.items(spark, sf_dir).select("vec_id", "image"), "vec_id").drop("vec_id")


WIDE = {
    "wide": """SELECT image, max(assigned) FILTER (category='grain') AS grain,
      max(assigned) FILTER (category='hue') AS hue FROM labels_out GROUP BY image""",
    "fixes": """SELECT image, 'h' || (event_id%5)::VARCHAR AS hue, CASE WHEN event_id%2=0 THEN 'g' || (event_id%4)::VARCHAR END AS grain
      FROM events JOIN items ON vec_id = user_id WHERE event_type='error'
      QUALIFY row_number() OVER (PARTITION BY image ORDER BY event_id DESC) = 1""",
    "fixed": """SELECT w.image, coalesce(f.grain, w.grain) AS grain, coalesce(f.hue, w.hue) AS hue, f.image IS NOT NULL AS corrected
      FROM wide w LEFT JOIN fixes f ON f.image = w.image""",
}


@register("wide_labels", I.sql("SELECT * FROM wide", "labels_out", extra={"wide": WIDE["wide"]}))
def wide_labels(spark, sf_dir):
    return wide(spark, sf_dir)


@register("corrections", I.sql("SELECT * FROM fixed", "labels_out", "items", extra=WIDE))
def apply_corrections(spark, sf_dir):
    return export.apply_corrections(
        wide(spark, sf_dir), corrections(spark, sf_dir), I.CATEGORIES
    )


@register(
    "export_names",
    I.sql(
        """SELECT image, 'item_' || printf('%05d', row_number() OVER (ORDER BY image)) || '.jpg' AS new_name,
        row_number() OVER (ORDER BY image) AS seq FROM (SELECT o_orderpriority || '/' || o_orderkey AS image FROM orders)""",
    ),
)
def export_names(spark, sf_dir):
    names = I.table(spark, sf_dir, "orders").select(
        F.concat("o_orderpriority", F.lit("/"), F.col("o_orderkey").cast("string")).alias("image")
    )
    return export.export_names(names)


@register(
    "export_clean",
    I.sql(
        """SELECT 'item_' || printf('%05d', row_number() OVER (ORDER BY image)) || '.jpg' AS image, grain, hue FROM fixed""",
        "labels_out", "items",
        extra=WIDE,
    ),
)
def export_clean(spark, sf_dir):
    return steps.export_step(
        I.records(spark, sf_dir), I.CATEGORIES, corrections(spark, sf_dir)
    )["clean"]


@register(
    "export_distribution",
    I.sql(
        """SELECT category, label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY category), 6) AS percent
        FROM (SELECT 'grain' AS category, grain AS label FROM fixed UNION ALL SELECT 'hue', hue FROM fixed) GROUP BY category, label""",
        "labels_out", "items",
        extra=WIDE,
    ),
)
def export_distribution(spark, sf_dir):
    fixed = apply_corrections(spark, sf_dir)
    return export.distribution(fixed, I.CATEGORIES).withColumn("percent", F.round("percent", 6))


@register(
    "first_locations",
    I.sql(
        """SELECT image, CASE WHEN kept THEN 'labeled/' ELSE 'deduped/' END || image AS path,
        CASE WHEN kept THEN 0 ELSE 1 END::INT AS place FROM decisions""",
        "decisions",
    ),
)
def first_locations(spark, sf_dir):
    decided = I.decisions(spark, sf_dir)

    def place(df, folder):
        return df.select("image", F.concat(F.lit(folder + "/"), "image").alias("path"))

    return export.first_locations(
        place(decided.where("kept"), "labeled"), place(I.items(spark, sf_dir), "deduped")
    )


# Manifest


@register(
    "manifest_upsert",
    I.sql(
        """SELECT coalesce(r.image, p.image) AS image,
          coalesce(r.image IS NULL OR i.vec_id % 4 <> 3 OR b.image IS NULL, true) AS dedup_kept,
          CASE WHEN r.image IS NULL THEN 'older.jpg' WHEN i.vec_id % 4 = 3 THEN b.image END AS duplicate_of,
          CASE WHEN r.image IS NULL THEN p.filter_kept ELSE r.kept END AS filter_kept,
          CASE WHEN r.image IS NULL THEN 'before' ELSE r.reason END AS reason,
          CASE WHEN r.image IS NULL OR r.reason IN ('resume_existing', 'load_error') THEN p.positive ELSE r.positive END AS positive,
          CASE WHEN r.image IS NULL OR r.reason IN ('resume_existing', 'load_error') THEN p.negative ELSE r.negative END AS negative,
          CASE WHEN r.kept OR p.image IS NOT NULL THEN true END AS labeled,
          CASE WHEN r.kept THEN l.assigned ELSE p.hue END AS hue
        FROM resumed_log r JOIN items i ON i.image = r.image JOIN labels_out l ON l.image = r.image AND l.category = 'hue'
        LEFT JOIN items b ON b.vec_id = i.vec_id - 1
        FULL JOIN earlier p ON p.image = r.image""",
        "scores", "labels_out",
        extra={
            **filtering.RESUMED,
            "earlier": """SELECT CASE WHEN vec_id % 4 = 0 THEN 'gone_' || image ELSE image END AS image, false AS filter_kept,
              0.5::DOUBLE AS positive, 0.25::DOUBLE AS negative, 'old' AS hue FROM items WHERE vec_id % 2 = 0""",
        },
    ),
)
def manifest_upsert(spark, sf_dir):
    """Three steps merged onto the manifest of an earlier run, itself half of all items.

    Some of its images are gone since. Explicit nulls (no longer a duplicate) overwrite;
    keys that a resumed or unreadable item lacks leave the older scores.
    """
    everything, decided = I.items(spark, sf_dir), materialize(filtering.resumed_decisions(spark, sf_dir))
    even = everything.where("vec_id % 2 = 0")
    name = F.when(F.col("vec_id") % 4 == 0, F.concat(F.lit("gone_"), F.col("image"))).otherwise(F.col("image"))
    earlier = even.select(name.alias("image"))
    none = spark.createDataFrame([], S.MANIFEST)
    state = manifest.upsert(
        none,
        "dedup",
        earlier.select("image", F.lit(True).alias("kept"), F.lit("older.jpg").alias("duplicate_of")),
    )
    state = manifest.upsert(
        state,
        "filter",
        earlier.select(
            "image",
            F.lit(False).alias("kept"),
            F.lit("before").alias("reason"),
            F.lit(0.5).alias("positive_score"),
            F.lit(0.25).alias("negative_score"),
        ),
    )
    old = F.create_map(F.lit("hue"), F.lit("old"))
    state = materialize(
        manifest.upsert(state, "label", earlier.select("image", F.lit(True).alias("labeled"), old.alias("categories")))
    )
    first = everything.select((F.col("vec_id") + 1).alias("vec_id"), F.col("image").alias("duplicate_of"))
    dups = everything.where("vec_id % 4 = 3").join(first, "vec_id").select("image", "duplicate_of")
    state = manifest.upsert(state, "dedup", manifest.dedup_updates(everything, dups))
    state = manifest.upsert(state, "filter", manifest.filter_updates(decided))
    labelled = labeling.keep_only(I.records(spark, sf_dir), decided.where("kept"))
    state = manifest.upsert(state, "label", manifest.label_updates(labelled))
    return state.select(
        "image",
        F.col("dedup.kept").alias("dedup_kept"),
        "dedup.duplicate_of",
        F.col("filter.kept").alias("filter_kept"),
        "filter.reason",
        F.col("filter.positive_score").alias("positive"),
        F.col("filter.negative_score").alias("negative"),
        "label.labeled",
        F.col("label.categories")["hue"].alias("hue"),
    )


# Composed


@register(
    "logged_margins",
    I.sql(
        """SELECT image, overlay - clean > 0.01 OR flagged AS overlay_fail, coalesce(positive < 0.0025, false) AS threshold_fail
        FROM (SELECT image, flagged, round(positive, 4) AS positive, round(overlay, 4) AS overlay, round(clean, 4) AS clean FROM decisions)""",
        "decisions",
    ),
)
def logged_margins(spark, sf_dir):
    """Margins re-derived from scores as logged, with four decimals."""
    found = scoring.margin_analysis(I.decisions(spark, sf_dir), I.THRESHOLDS, digits=4)
    return found.select("image", "overlay_fail", "threshold_fail")


LEFT = "image NOT IN (SELECT image FROM dups)"


@register(
    "run_all_counts",
    greedy_sql(
        f"""SELECT from_step, to_step, from_count, to_count, round(c, 6) AS conversion_pct, round(100 - c, 6) AS drop_pct
        FROM (SELECT lag(step) OVER w AS from_step, step AS to_step, lag(n) OVER w AS from_count, n AS to_count,
                n * 100.0::DOUBLE / lag(n) OVER w AS c
          FROM (SELECT 'download' AS step, 0 AS ord, count(*) AS n FROM items
            UNION ALL SELECT 'resize', 1, count(*) FROM items
            UNION ALL SELECT 'dedup', 2, count(*) FROM items WHERE {LEFT}
            UNION ALL SELECT 'filter', 3, count(*) FROM decisions WHERE kept AND {LEFT}
            UNION ALL SELECT 'label', 4, count(*) FROM decisions WHERE kept AND {LEFT})
          WINDOW w AS (ORDER BY ord)) WHERE from_step IS NOT NULL""",
        "SELECT image, phash FROM hashes",
        I.DUP_BITS,
        "hashes",
        "items",
        "decisions",
    ),
)
def run_all_counts(spark, sf_dir):
    """Dedup, filter and label of all items in one run, as step counts."""
    hashed = I.items(spark, sf_dir).join(I.hashes(spark, sf_dir), "image")
    outcome = steps.run_all(
        hashed, I.group_prompts(spark, sf_dir), I.label_prompts(spark, sf_dir),
        threshold=I.DUP_BITS, thresholds=I.THRESHOLDS,
    )
    rows = steps.dashboard(outcome, hashed, hashed)["funnel"]
    return rows.withColumn("conversion_pct", F.round("conversion_pct", 6)).withColumn(
        "drop_pct", F.round("drop_pct", 6)
    )


