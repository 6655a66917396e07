"""Queries on harvesting, resolution, names, step statistics and browsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_curate.catalog import filtering
from spark_curate.catalog import inputs as I
from spark_curate.functions import names as N
from spark_curate.functions.session import materialize
from spark_curate.operators import harvest, monitor, resolution, sequence, skew

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


# Raw files: one per order, with derived path and dimensions.

RAW = """SELECT CASE WHEN k%97=0 THEN 'Image_' || k || '.jpg'
    ELSE ['bing','google','flickr'][k%3+1] || '/q' || (k%11) || '/Image_' || (k//2) ||
      CASE k%4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.webp' ELSE '.gif' END END AS path,
  CASE WHEN k%17=0 THEN NULL ELSE (300 + (k*37)%1500) END::INT AS width, (400 + (k*91)%1300)::INT AS height, k
  FROM (SELECT o_orderkey AS k FROM orders)"""


def raw_files(spark, sf_dir):
    k = F.col("o_orderkey")
    text = k.cast("string")
    source = F.when(k % 3 == 0, "bing").when(k % 3 == 1, "google").otherwise("flickr")
    ending = F.when(k % 4 == 0, ".jpg").when(k % 4 == 1, ".PNG").when(k % 4 == 2, ".webp").otherwise(".gif")
    nested = F.concat(
        source, F.lit("/q"), (k % 11).cast("string"), F.lit("/Image_"),
        F.floor(k / 2).cast("string"), ending,
    )
    return I.table(spark, sf_dir, "orders").select(
        F.when(k % 97 == 0, F.concat(F.lit("Image_"), text, F.lit(".jpg"))).otherwise(nested).alias("path"),
        F.when(k % 17 != 0, (300 + (k * 37) % 1500).cast("int")).alias("width"),
        (400 + (k * 91) % 1300).cast("int").alias("height"),
        k.alias("k"),
    )


NAMES = {
    "raw": RAW,
    "parts": """SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS parent,
      split_part(path, '/', -1) AS file FROM raw""",
    "named": r"""SELECT *, CASE WHEN parent='' THEN file ELSE substr(md5(parent),1,8) || '_' || file END AS canonical,
      substr(md5(CASE WHEN parent='' THEN '.' ELSE parent END),1,8) || '_' || regexp_replace(file, '\.[^.]+$', '') AS name,
      lower(regexp_extract(file, '\.([^.]+)$', 1)) AS suffix FROM parts""",
    "steps": """SELECT *, CASE WHEN width IS NULL THEN 'error' WHEN least(width, height) < 512 THEN 'discarded'
      WHEN least(width, height) > 1024 THEN 'resized' ELSE 'kept' END AS status FROM named""",
}


@register(
    "canonical_names",
    I.sql("SELECT path, canonical, name, suffix, parent FROM named", extra=NAMES),
)
def canonical_names(spark, sf_dir):
    path = F.col("path")
    return raw_files(spark, sf_dir).select(
        "path",
        N.canonical_name(path).alias("canonical"),
        N.resized_name(path).alias("name"),
        N.suffix(path).alias("suffix"),
        N.parent_path(path).alias("parent"),
    )


@register(
    "resolution_status",
    I.sql(
        """SELECT path, name, width, height, status,
        CASE status WHEN 'kept' THEN width WHEN 'resized' THEN round_even(width * (1024.0::DOUBLE / least(width,height)), 0) END::INT AS new_width,
        CASE status WHEN 'kept' THEN height WHEN 'resized' THEN round_even(height * (1024.0::DOUBLE / least(width,height)), 0) END::INT AS new_height
        FROM steps""",
        extra=NAMES,
    ),
)
def resolution_status(spark, sf_dir):
    return resolution.resolution_step(raw_files(spark, sf_dir))


@register(
    "resize_longest_side",
    I.sql(
        """SELECT path, CASE WHEN greatest(width,height) > 1024 THEN round_even(width * (1024.0::DOUBLE / greatest(width,height)), 0) ELSE width END::INT AS new_width,
        CASE WHEN greatest(width,height) > 1024 THEN round_even(height * (1024.0::DOUBLE / greatest(width,height)), 0) ELSE height END::INT AS new_height
        FROM raw WHERE width IS NOT NULL""",
        extra=NAMES,
    ),
)
def resize_longest_side(spark, sf_dir):
    width, height, _ = resolution.target_dims(F.col("width"), F.col("height"), mode="longest_side")
    readable = raw_files(spark, sf_dir).where(F.col("width").isNotNull())
    return readable.select("path", width.alias("new_width"), height.alias("new_height"))


COUNT_STEPS = """SELECT count(*) AS total, count(*) FILTER (status IN ('kept','resized','skipped')) AS kept,
  count(*) FILTER (status='discarded') AS discarded, count(*) FILTER (status='resized') AS resized,
  count(*) FILTER (status='error') AS errors FROM """


@register("resolution_counts", I.sql(COUNT_STEPS + "steps", extra=NAMES))
def resolution_counts(spark, sf_dir):
    return resolution.resolution_counts(resolution.resolution_step(raw_files(spark, sf_dir)))


@register(
    "resolution_resume",
    I.sql(
        COUNT_STEPS
        + """(SELECT CASE WHEN name IN (SELECT name FROM steps WHERE status='kept') THEN 'skipped' ELSE status END AS status FROM steps)""",
        extra=NAMES,
    ),
)
def resolution_resume(spark, sf_dir):
    raw = raw_files(spark, sf_dir)
    earlier = resolution.resolution_step(raw).where(F.col("status") == "kept").select("name")
    return resolution.resolution_counts(resolution.resolution_step(raw, existing=earlier))


@register(
    "name_collisions",
    I.sql(
        """SELECT name, count(*) AS n, min(path) AS first_path FROM named GROUP BY name HAVING count(*) > 1""",
        extra={
            **NAMES,
            "raw": rf"""SELECT path, k FROM ({RAW}) UNION ALL
              SELECT regexp_replace(path, '\.[^.]+$', '.jpeg') AS path, k FROM ({RAW}) WHERE k % 10 = 0""",
        },
    ),
)
def name_collisions(spark, sf_dir):
    """Every tenth file has a twin of another suffix in its folder."""
    raw = raw_files(spark, sf_dir).select("path", "k")
    twin = F.regexp_replace("path", r"\.[^.]+$", ".jpeg").alias("path")
    return resolution.name_collisions(raw.unionByName(raw.where("k % 10 = 0").select(twin, "k")))


@register(
    "find_originals",
    I.sql(
        """SELECT s.name || '.jpg' AS image, o.path FROM (SELECT DISTINCT name FROM steps WHERE status IN ('kept','resized')) s
        LEFT JOIN (SELECT name, path FROM named WHERE suffix IN ('jpg','png','webp') AND parent <> ''
          QUALIFY row_number() OVER (PARTITION BY name ORDER BY suffix, path) = 1) o ON o.name = s.name""",
        extra=NAMES,
    ),
)
def find_originals(spark, sf_dir):
    raw = materialize(raw_files(spark, sf_dir))
    done = resolution.resolution_step(raw).where(F.col("new_width").isNotNull())
    resized = done.select(F.concat("name", F.lit(".jpg")).alias("image")).distinct()
    return resolution.find_originals(resized, raw)


# Step statistics


@register(
    "download_stats",
    I.sql(
        """SELECT 'source' AS kind, split_part(path,'/',1) AS name, count(*) AS n FROM parts WHERE parent<>'' GROUP BY 2
        UNION ALL SELECT 'query', split_part(path,'/',2), count(*) FROM parts WHERE parent<>'' GROUP BY 2""",
        extra=NAMES,
    ),
)
def download_stats(spark, sf_dir):
    return monitor.download_stats(raw_files(spark, sf_dir))


@register(
    "download_totals",
    I.sql(
        """SELECT source, count(*) AS n FROM (SELECT CASE WHEN parent<>'' THEN split_part(path,'/',1) ELSE 'none' END AS source
        FROM parts) GROUP BY ROLLUP(source)""",
        extra=NAMES,
    ),
)
def download_totals(spark, sf_dir):
    source = F.coalesce(N.source_of_path(F.col("path")), F.lit("none"))
    return harvest.download_totals(raw_files(spark, sf_dir).select(source.alias("source")))


@register(
    "existing_counts",
    I.sql(
        """SELECT CASE WHEN parent<>'' THEN split_part(path,'/',1) END AS source,
        CASE WHEN parent<>'' THEN split_part(path,'/',2) END AS slug, count(*) AS n FROM named
        WHERE suffix IN ('jpg','png','webp','gif') GROUP BY 1, 2""",
        extra=NAMES,
    ),
)
def existing_counts(spark, sf_dir):
    return harvest.existing_counts(raw_files(spark, sf_dir))


PENDING = {
    **NAMES,
    "have": """SELECT split_part(path,'/',1) AS source, split_part(path,'/',2) AS slug, count(*) AS n
               FROM parts WHERE parent<>'' GROUP BY 1, 2""",
    "asked": """SELECT DISTINCT 'Q' || (p_partkey%13)::VARCHAR AS query, 'q' || (p_partkey%13)::VARCHAR AS slug FROM part""",
}


@register(
    "pending_work",
    I.sql(
        """SELECT s.source, query, asked.slug, (460 - coalesce(n, 0))::BIGINT AS remaining
        FROM asked CROSS JOIN (VALUES ('bing'), ('google'), ('flickr')) s(source)
        LEFT JOIN have ON have.source = s.source AND have.slug = asked.slug WHERE coalesce(n, 0) < 460""",
        extra=PENDING,
    ),
)
def pending_work(spark, sf_dir):
    asked = I.table(spark, sf_dir, "part").select(
        F.concat(F.lit("Q"), (F.col("p_partkey") % 13).cast("string")).alias("query")
    ).distinct()
    have = harvest.existing_counts(raw_files(spark, sf_dir))
    return harvest.pending_work(asked, ("bing", "google", "flickr"), have, 460).withColumn(
        "remaining", F.col("remaining").cast("bigint")
    )


@register(
    "name_sources",
    I.sql(
        """SELECT source, count(*) AS n FROM (SELECT CASE WHEN len(p) < 3 THEN 'unknown' WHEN p[2]='Image' THEN 'bing'
        ELSE p[2] END AS source FROM (SELECT string_split(canonical, '_') AS p FROM named)) GROUP BY source""",
        extra=NAMES,
    ),
)
def name_sources(spark, sf_dir):
    name = N.canonical_name(F.col("path"))
    return raw_files(spark, sf_dir).groupBy(N.source_of_name(name).alias("source")).agg(F.count("*").alias("n"))


SOURCE_SQL = "CASE split_part(image,'_',2) WHEN 'Image' THEN 'bing' ELSE split_part(image,'_',2) END"


@register(
    "filter_source_stats",
    I.sql(
        f"""SELECT source, outcome, count(*) AS n, grouping(source, outcome)::INT AS level FROM (
        SELECT {SOURCE_SQL} AS source, CASE WHEN kept THEN 'kept' WHEN reason='overlay' THEN 'overlay' ELSE 'low_score' END AS outcome
        FROM decisions) GROUP BY CUBE(source, outcome)""",
        "decisions",
    ),
)
def filter_source_stats(spark, sf_dir):
    return monitor.filter_stats(I.decisions(spark, sf_dir))


@register(
    "overlay_stats",
    I.sql(
        """SELECT count(*) AS total, count(*) FILTER (flagged) AS flagged, count(*) FILTER (NOT flagged) AS clean
        FROM decisions""",
        "decisions",
    ),
)
def overlay_stats(spark, sf_dir):
    return monitor.overlay_stats(I.decisions(spark, sf_dir))


@register("source_list", I.sql(f"SELECT DISTINCT {SOURCE_SQL} AS source FROM items", "items"))
def source_list(spark, sf_dir):
    return monitor.sources(I.items(spark, sf_dir))


COUNTS = {
    **NAMES,
    "counts": """SELECT 'download' AS step, 0 AS step_ord, count(*) AS n FROM raw
      UNION ALL SELECT 'resize', 1, count(*) FROM steps WHERE status IN ('kept','resized')
      UNION ALL SELECT 'dedup', 2, count(DISTINCT md5(text)) FROM documents
      UNION ALL SELECT 'filter', 3, count(*) FROM decisions WHERE kept
      UNION ALL SELECT 'label', 4, count(*) FROM decisions WHERE kept""",
    "rows_": """SELECT lag(step) OVER w AS from_step, step AS to_step, lag(n) OVER w AS from_count, n AS to_count
      FROM counts WINDOW w AS (ORDER BY step_ord)""",
    "funnel": """SELECT *, to_count * 100.0::DOUBLE / from_count AS c FROM rows_ WHERE from_step IS NOT NULL""",
}


def steps(spark, sf_dir):
    """Counts of all steps, each source read once; written, since a few rows are read often."""
    decided = I.decisions(spark, sf_dir)
    raw = resolution.resolution_step(raw_files(spark, sf_dir))
    texts = I.table(spark, sf_dir, "documents").select(F.md5("text").alias("h"))
    return materialize(
        monitor.step_counts(
            {
                "download": raw,
                "resize": (raw, F.count("new_width")),
                "dedup": (texts, F.count_distinct("h")),
                "filter": (decided, F.count_if("kept")),
                "label": (decided, F.count_if("kept")),
            }
        )
    )


@register(
    "funnel",
    I.sql(
        """SELECT from_step, to_step, from_count, to_count, round(c, 6) AS conversion_pct,
        round(100 - c, 6) AS drop_pct FROM funnel""",
        "decisions",
        extra=COUNTS,
    ),
)
def funnel(spark, sf_dir):
    rows = monitor.funnel(steps(spark, sf_dir))
    return rows.withColumn("conversion_pct", F.round("conversion_pct", 6)).withColumn(
        "drop_pct", F.round("drop_pct", 6)
    )


@register(
    "anomalies",
    I.sql(
        """SELECT 'high' AS severity, 'retention' AS rule, to_step AS step, round(c, 6) AS rate FROM funnel WHERE c < 35
        UNION ALL SELECT 'high', 'rejection', 'filter', round(r, 6) FROM (SELECT count(*) FILTER (NOT kept) * 100.0::DOUBLE / count(*) AS r
          FROM decisions) WHERE r > 75
        UNION ALL SELECT 'warn', 'removal', 'dedup', round(r, 6) FROM (SELECT (count(*) - count(DISTINCT md5(text))) * 100.0::DOUBLE / count(*) AS r
          FROM documents) WHERE r > 45""",
        "decisions",
        extra=COUNTS,
    ),
)
def anomalies(spark, sf_dir):
    counts = steps(spark, sf_dir)
    alarms = monitor.anomalies(monitor.funnel(counts), monitor.step_rates(counts))
    return alarms.withColumn("rate", F.round("rate", 6))


@register(
    "first_input",
    I.sql(
        """SELECT step, n FROM counts WHERE n > 0 AND step IN ('filter','dedup','resize','download')
        ORDER BY list_position(['filter','dedup','resize','download'], step) LIMIT 1""",
        "decisions",
        extra=COUNTS,
    ),
)
def first_input(spark, sf_dir):
    return monitor.first_input(steps(spark, sf_dir), ("filter", "dedup", "resize", "download"))


@register(
    "readiness",
    I.sql(
        """SELECT s.step_ord, s.step, CASE WHEN any_ THEN bool_or(has) ELSE coalesce(bool_and(has), true) END AS ready,
        arg_min(artifact, p) FILTER (has) AS used,
        CASE WHEN any_ THEN '' ELSE coalesce(string_agg(artifact, ',' ORDER BY p) FILTER (NOT has), '') END AS missing,
        CASE WHEN any_ THEN NULL ELSE arg_min(hint, p) FILTER (NOT has) END AS run_first
        FROM (VALUES (0,'download',false),(1,'resize',true),(2,'dedup',true),(3,'filter',true),(4,'label',true),
          (5,'eval-sample',false),(6,'eval-report',false),(7,'cluster-review',false)) s(step_ord, step, any_)
        LEFT JOIN (SELECT step, p, artifact, hint, coalesce(n, 0) > 0 AS has FROM (VALUES
          ('resize',0,'raw','download'),('dedup',0,'resized','download'),('dedup',1,'raw','download'),
          ('filter',0,'deduped','download'),('filter',1,'resized','download'),('filter',2,'raw','download'),
          ('label',0,'filtered','download'),('label',1,'deduped','download'),('label',2,'resized','download'),('label',3,'raw','download'),
          ('eval-sample',0,'labels','label'),('eval-report',0,'labels','eval-sample'),('eval-report',1,'eval_sample','eval-sample'),
          ('cluster-review',0,'labels','label'),('cluster-review',1,'embeddings','label'),('cluster-review',2,'eval_sample','eval-sample'),
          ('cluster-review',3,'eval_metrics','eval-report')) w(step, p, artifact, hint)
          LEFT JOIN (SELECT CASE step WHEN 'download' THEN 'raw' WHEN 'resize' THEN 'resized' WHEN 'dedup' THEN 'deduped'
            WHEN 'filter' THEN 'filtered' ELSE 'labels' END AS artifact, n FROM counts) USING (artifact)) USING (step)
        GROUP BY s.step_ord, s.step, any_""",
        "decisions",
        extra=COUNTS,
    ),
)
def readiness(spark, sf_dir):
    artifact = (
        F.when(F.col("step") == "download", "raw")
        .when(F.col("step") == "resize", "resized")
        .when(F.col("step") == "dedup", "deduped")
        .when(F.col("step") == "filter", "filtered")
        .otherwise("labels")
    )
    available = steps(spark, sf_dir).select(artifact.alias("artifact"), "n")
    return monitor.readiness(spark, available).withColumn("missing", F.array_join("missing", ","))


# Browsing


@register(
    "browse_rejected",
    I.sql(
        """SELECT image, rejection_mode, decision_band, nearest_boundary FROM margins
        WHERE NOT kept AND split_part(image,'_',2)='google' AND decision_band='borderline'
        AND contains(lower(image), '0') ORDER BY image LIMIT 60 OFFSET 60""",
        "decisions",
        extra=filtering.MARGINS,
    ),
)
def browse_rejected(spark, sf_dir):
    wanted = monitor.Browse(source="google", decision_band="borderline", search="0")
    rejected = filtering.margins(spark, sf_dir).where(~F.col("kept"))
    found = rejected.where(wanted.predicate()).select(
        "image", "rejection_mode", "decision_band", "nearest_boundary"
    )
    return sequence.page(found, ["image"], 2, 60)


@register(
    "browse_kept",
    I.sql(
        """SELECT image, decision_band, nearest_boundary FROM margins WHERE kept AND nearest_boundary='target_threshold'
        ORDER BY image LIMIT 60""",
        "decisions",
        extra=filtering.MARGINS,
    ),
)
def browse_kept(spark, sf_dir):
    wanted = monitor.Browse(nearest_boundary="target_threshold", overlay="clean")
    kept = filtering.margins(spark, sf_dir).where("kept")
    found = kept.where(wanted.predicate()).select("image", "decision_band", "nearest_boundary")
    return sequence.page(found, ["image"], 1, 60)


@register(
    "browse_labels",
    I.sql(
        """SELECT image, grain, hue FROM (SELECT image, max(assigned) FILTER (category='grain') AS grain,
        max(assigned) FILTER (category='hue') AS hue FROM labels_out GROUP BY image)
        WHERE hue='h1' ORDER BY image LIMIT 60""",
        "labels_out",
    ),
)
def browse_labels(spark, sf_dir):
    listing = monitor.with_labels(I.items(spark, sf_dir).select("image"), I.records(spark, sf_dir))
    found = listing.where(monitor.Browse(labels={"hue": "h1"}).predicate())
    return sequence.page(found, ["image"], 1, 60).select(
        "image", *[F.col("predicted")[c].alias(c) for c in I.CATEGORIES]
    )


@register(
    "browse_raw",
    I.sql(
        """SELECT path AS image FROM parts WHERE split_part(path,'/',1)='flickr' AND parent='flickr/q5'
        ORDER BY path LIMIT 200""",
        extra=NAMES,
    ),
)
def browse_raw(spark, sf_dir):
    listing = raw_files(spark, sf_dir).select(F.col("path").alias("image"))
    wanted = monitor.Browse(source="flickr", query="q5")
    found = listing.where(wanted.predicate(raw_paths=True))
    return sequence.page(found, ["image"], 1, monitor.page_size(500, 200))


@register(
    "browse_info",
    I.sql(
        """SELECT count(*) AS total, 3::BIGINT AS page, 60::BIGINT AS per_page,
        greatest(1, ceil(count(*) / 60))::BIGINT AS pages FROM raw WHERE path LIKE 'google/%'""",
        extra=NAMES,
    ),
)
def browse_info(spark, sf_dir):
    listing = raw_files(spark, sf_dir).select(F.col("path").alias("image"))
    found = listing.where(monitor.Browse(source="google").predicate(raw_paths=True))
    return sequence.page_info(found, 3, 60)


# Harvest

HREF = harvest.LinkRules(patterns=(r'href="([^"]+)"',), skipped=("icon", "logo"))

LINKS = {
    "l": """SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS url,
      generate_subscripts(regexp_extract_all(html, 'href="([^"]+)"', 1), 1) AS pos FROM pages""",
    "f": """SELECT page_id, url, min(pos) AS pos FROM l WHERE len(url) < 2000 AND NOT contains(url, 'icon')
      AND NOT contains(url, 'logo') GROUP BY page_id, url""",
    "links": """SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INT AS ord, url FROM f""",
    "hosts": """SELECT links.url, regexp_extract(p.url, '^https?://([^/?#]+)', 1) AS query, (p.page_id * 1000 + ord)::BIGINT AS ord
      FROM links JOIN pages p ON p.page_id = links.page_id""",
}


def host_links(spark, sf_dir):
    """Links of all pages of a host, the host being the query."""
    pages = I.table(spark, sf_dir, "pages")
    links = harvest.page_links(pages, HREF)
    hosts = pages.select("page_id", N.url_host(F.col("url")).alias("query"))
    return links.join(hosts, "page_id").select(
        "query", (F.col("page_id") * 1000 + F.col("ord")).alias("ord"), "url"
    )


@register("page_links", I.sql("SELECT * FROM links", extra=LINKS))
def page_links(spark, sf_dir):
    return harvest.page_links(I.table(spark, sf_dir, "pages"), HREF)


@register("page_link_quota", I.sql("SELECT * FROM links WHERE ord < 3", extra=LINKS))
def page_link_quota(spark, sf_dir):
    return harvest.page_links(I.table(spark, sf_dir, "pages"), HREF, limit=3)


@register(
    "first_seen_links",
    I.sql("SELECT query, url, min(ord) AS ord FROM hosts GROUP BY query, url", extra=LINKS),
)
def first_seen_links(spark, sf_dir):
    return harvest.first_seen(host_links(spark, sf_dir))


@register(
    "link_quota",
    I.sql(
        """SELECT query, url, ord FROM (SELECT query, url, min(ord) AS ord FROM hosts GROUP BY query, url)
        QUALIFY row_number() OVER (PARTITION BY query ORDER BY ord, url) <= 4""",
        extra=LINKS,
    ),
)
def link_quota(spark, sf_dir):
    return harvest.quota(harvest.first_seen(host_links(spark, sf_dir)), 4)



def search_sql(stride):
    return I.sql(
        """SELECT query, page, ord, url FROM new JOIN read_ USING (query, page)
        QUALIFY row_number() OVER (PARTITION BY query ORDER BY page, ord) <= 25""",
        extra={
            **LINKS,
            "ranked": f"""SELECT p.lang AS query, (dense_rank() OVER (PARTITION BY p.lang ORDER BY p.page_id) - 1) * {stride} AS page, links.ord, links.url
               FROM links JOIN (SELECT page_id, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang FROM pages) p USING (page_id)""",
            "new": """SELECT query, page, ord, url FROM ranked
               QUALIFY row_number() OVER (PARTITION BY query, url ORDER BY page, ord) = 1""",
            "fresh": """SELECT query, page, count(n.url) AS new FROM (SELECT DISTINCT query, page FROM ranked) r
               LEFT JOIN new n USING (query, page) GROUP BY query, page""",
            "ends": """SELECT query, page, coalesce(sum(new) OVER e, 0) AS before,
               lag(page) OVER (PARTITION BY query ORDER BY page) >= 1 AND new = 0 AND lag(new) OVER (PARTITION BY query ORDER BY page) = 0 AS ends FROM fresh
               WINDOW e AS (PARTITION BY query ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
            "read_": """SELECT query, page FROM (SELECT *, coalesce(bool_or(ends) OVER (PARTITION BY query ORDER BY page
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS ended FROM ends)
               WHERE page = 0 OR (before < 25 AND NOT ended)""",
        },
    )


def searched(spark, sf_dir, stride):
    """Pages of a language stand for the result pages of a query, numbered in id order."""
    pages = I.table(spark, sf_dir, "pages").withColumn(
        "query", F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    )
    numbered = sequence.global_sequence(pages.select("query", "page_id"), ["query", "page_id"])
    starts = numbered.groupBy("query").agg(F.min("seq").alias("start"), F.count("*").alias("n"))
    numbers = skew.join_unique(numbered, starts, "query").select(
        "page_id", "query", ((F.col("seq") - F.col("start")) * stride).alias("page")
    )
    urls = pages.select(
        "page_id",
        F.array_distinct(
            F.filter(
                F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)),
                lambda u: ~F.contains(u, F.lit("icon")) & ~F.contains(u, F.lit("logo")) & (F.length(u) < 2000),
            )
        ).alias("urls"),
    )
    return harvest.search_until(numbers.join(urls, "page_id").select("query", "page", "urls"), 25)


@register("search_until", search_sql(1))
def search_until(spark, sf_dir):
    return searched(spark, sf_dir, 1)


@register("search_until_gaps", search_sql(7))
def search_until_gaps(spark, sf_dir):
    """The same with six page numbers left out between any two."""
    return searched(spark, sf_dir, 7)


@register(
    "feed_links",
    I.sql(
        """SELECT query, (row_number() OVER (PARTITION BY query, page_id ORDER BY pos) - 1)::INT AS ord, url FROM (
        SELECT page_id, page_id AS query, 'https://photos.example.com' || url || '_b.jpg' AS url, pos
        FROM (SELECT page_id, url, min(pos) AS pos FROM l GROUP BY page_id, url))""",
        extra={"l": LINKS["l"]},
    ),
)
def feed_links(spark, sf_dir):
    """Feed bodies made of each page's links."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    media = F.transform(
        links,
        lambda u: F.struct(
            F.struct(F.concat(F.lit("https://photos.example.com"), u, F.lit("_m.jpg")).alias("m")).alias("media")
        ),
    )
    feeds = I.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("query"), F.to_json(F.struct(media.alias("items"))).alias("body")
    )
    return harvest.feed_links(feeds)


@register(
    "static_host_links",
    I.sql(
        """SELECT page_id, url, ord FROM (SELECT page_id,
        unnest(list_transform(regexp_extract_all(body, '(live\\.staticflickr\\.com/\\S+?\\.jpg)', 1),
          lambda m: 'https://' || regexp_replace(m, '_[a-z]\\.jpg$', '_b.jpg'))) AS url,
        generate_subscripts(regexp_extract_all(body, '(live\\.staticflickr\\.com/\\S+?\\.jpg)', 1), 1) AS ord
        FROM (SELECT page_id, regexp_replace(html, 'href="([^"]+)"', 'live.staticflickr.com\\1_z.jpg', 'g') AS body FROM pages))""",
    ),
)
def static_host_links(spark, sf_dir):
    body = F.regexp_replace("html", 'href="([^"]+)"', "live.staticflickr.com$1_z.jpg")
    found = I.table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(harvest.static_host_links(body)).alias("ord", "url")
    )
    return found.select("page_id", "url", (F.col("ord") + 1).cast("bigint").alias("ord"))


@register(
    "admitted_responses",
    I.sql(
        """SELECT query, ord, url, name FROM (SELECT source AS query, doc_id AS ord, 'http://example.com/' || doc_id AS url,
        'google_' || printf('%05d', doc_id) || '_' || substr(sha256('http://example.com/' || doc_id), 1, 16) ||
          CASE lang WHEN 'de' THEN '.png' WHEN 'fr' THEN '.webp' ELSE '.jpg' END AS name
        FROM documents WHERE lang <> 'es' AND octet_length(encode(text)) >= 1000)
        QUALIFY row_number() OVER (PARTITION BY query ORDER BY ord) <= 8""",
    ),
)
def admitted_responses(spark, sf_dir):
    lang = F.col("lang")
    kind = F.when(lang == "es", "text/html").when(lang == "de", "image/png").when(
        lang == "fr", "image/webp").otherwise("image/jpeg")
    responses = I.table(spark, sf_dir, "documents").select(
        F.col("source").alias("query"),
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("http://example.com/"), F.col("doc_id").cast("string")).alias("url"),
        kind.alias("content_type"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return harvest.admitted_responses(responses, "google", 8)


@register(
    "query_texts",
    I.sql(
        r"""SELECT DISTINCT query, trim(regexp_replace(regexp_replace(trim(lower(query)), '[^\w\s-]', '', 'g'), '[\s_]+', '_', 'g'), '_') AS slug,
        replace(query, ' ', ',') AS tags, replace(url_encode(query), '%20', '+') AS encoded
        FROM (SELECT p_name || ' ~' || p_brand || '*  ' || p_type AS query FROM part)""",
    ),
)
def query_texts(spark, sf_dir):
    query = F.concat("p_name", F.lit(" ~"), "p_brand", F.lit("*  "), "p_type")
    return I.table(spark, sf_dir, "part").select(query.alias("query")).distinct().select(
        "query",
        N.slugify(F.col("query")).alias("slug"),
        N.tag_list(F.col("query")).alias("tags"),
        N.encoded_query(F.col("query")).alias("encoded"),
    )


