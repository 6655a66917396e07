"""Candidate urls from crawled pages, quotas, admission and remaining work."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_curate.functions import names as N
from spark_curate.functions.session import materialize

# Patterns of image links in a result page, in order of use.
IMAGE_PATTERNS = (
    r'(?i)"(https?://[^"]+\.(?:jpg|jpeg|png|webp)(?:\?[^"]*)?)"',
    r'(?i)\["(https?://[^"]+\.(?:jpg|jpeg|png|webp)(?:\?[^"]*)?)"',
)

# Urls containing one of these are thumbnails, icons or the like.
SKIPPED_PARTS = (
    "gstatic.com",
    "google.com",
    "googleapis.com",
    "googleusercontent.com/images",
    "favicon",
    "icon",
    "logo",
    "thumbnail",
    "/th?",
    "encrypted-tbn",
)

# Longest url taken, smallest image body taken.
MAX_URL = 2000
MIN_BODY = 1000

# Links to a static photo host and the suffixes of its sizes.
STATIC_HOST_PATTERN = r"(live\.staticflickr\.com/\S+?\.jpg)"
SIZE_SUFFIX = r"_[a-z]\.jpg$"
LARGE_SUFFIX = "_b.jpg"

# Candidates taken per wanted image, by kind of search.
OVERFETCH_PAGES = 3.0
OVERFETCH_SEARCH = 1.4


@dataclass(frozen=True)
class LinkRules:
    """What counts as a link: patterns with one group each, and what to skip."""

    patterns: tuple[str, ...] = IMAGE_PATTERNS
    skipped: tuple[str, ...] = SKIPPED_PARTS
    max_length: int = MAX_URL
    skip_same_host: bool = False


def page_links(
    pages: DataFrame, rules: LinkRules = LinkRules(), limit: int | None = None, key: str = "page_id"
) -> DataFrame:
    """Distinct links of each page in order of first occurrence: key, ord, url.

    Matching, skipping and de-duplication happen inside the row: no shuffle.
    ``limit`` is the quota of links per page.
    """
    found = [F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in rules.patterns]
    every = F.concat(*found) if len(found) > 1 else found[0]

    def wanted(url: Column) -> Column:
        ok = F.length(url) < rules.max_length
        for part in rules.skipped:
            ok = ok & ~F.contains(url, F.lit(part))
        if rules.skip_same_host:
            ok = ok & ~N.url_host(url).eqNullSafe(N.url_host(F.col("url")))
        return ok

    links = F.array_distinct(F.filter(every, wanted))
    if limit is not None:
        links = F.slice(links, 1, limit)
    return pages.select(key, F.posexplode(links).alias("ord", "url"))


def first_seen(links: DataFrame, keys: Sequence[str] = ("query",), ord_: str = "ord") -> DataFrame:
    """Distinct urls per key with the position of their first occurrence."""
    return links.groupBy(*keys, "url").agg(F.min(ord_).alias(ord_))


def large_form(url: Column) -> Column:
    """The large size of a static-host photo url."""
    return F.regexp_replace(url, SIZE_SUFFIX, LARGE_SUFFIX)


def static_host_links(body: Column) -> Column:
    """All static-host photos of a page as large urls, in order."""
    return F.transform(
        F.regexp_extract_all(body, F.lit(STATIC_HOST_PATTERN), F.lit(1)),
        lambda m: large_form(F.concat(F.lit("https://"), m)),
    )


def feed_links(feeds: DataFrame) -> DataFrame:
    """Urls of a public feed (JSON ``items[].media.m``): query, ord, url.

    Malformed bodies and items without media give nothing.
    """
    parsed = F.from_json("body", "items array<struct<media:struct<m:string>>>")
    small = F.transform(parsed["items"], lambda i: i["media"]["m"])
    large = F.transform(
        F.filter(small, lambda u: u.isNotNull() & (u != "")),
        lambda u: F.replace(u, F.lit("_m.jpg"), F.lit(LARGE_SUFFIX)),
    )
    return feeds.select("query", F.posexplode(F.array_distinct(large)).alias("ord", "url"))


def quota(links: DataFrame, per_query: int, ord_: str = "ord") -> DataFrame:
    """First ``per_query`` urls of each query; partitions drop the rest early."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(ord_, "url"))
    return links.withColumn("_r", rank).where(F.col("_r") <= per_query).drop("_r")


def search_until(pages: DataFrame, target: int, parts: int | None = None) -> DataFrame:
    """Urls gathered by paging through search results: query, page, ord, url.

    ``pages`` holds query, page (feed results are page 0) and urls in order. Paging
    stops after two successive pages without a new url, or before a page once
    ``target`` urls are there; the result is cut at ``target``.

    Page numbers may have gaps: successive pages are those that follow each other in
    the table. The pages, a slim row each, are range-partitioned by query and page into
    ``parts`` (by default as the session says); each part works out its own stretch of a
    query, and what a stretch must know of the stretches before it is a few numbers per
    part. So a query of any number of pages is spread like the rest.
    """
    each = pages.select("query", "page", F.posexplode("urls").alias("ord", "url"))
    first = each.groupBy("query", "url").agg(F.min(F.struct("page", "ord")).alias("_f"))
    new = first.select("query", "_f.page", "_f.ord", "url")
    order = ["query", "page"]
    # a join, since a union whose sides look alike may be grouped without an exchange
    found = new.groupBy(*order).agg(F.count("*").alias("_n"))
    fresh = pages.select(*order).distinct().join(found, order, "left").select(*order, F.coalesce("_n", F.lit(0)).alias("new"))
    ranged = fresh.repartitionByRange(parts, *order) if parts else fresh.repartitionByRange(*order)
    placed = materialize(ranged.withColumn("_part", F.spark_partition_id()))
    stretch = Window.partitionBy("_part", "query").orderBy("page")
    earlier = stretch.rowsBetween(Window.unboundedPreceding, -1)
    last_page, last_new = F.lag("page").over(stretch), F.lag("new").over(stretch)
    counted = placed.select(
        "_part",
        "query",
        "page",
        "new",
        last_page.isNull().alias("_first"),
        F.coalesce(F.sum("new").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce((last_page >= 1) & (F.col("new") == 0) & (last_new == 0), F.lit(False)).alias("_ends"),
    ).withColumn("_ended", F.coalesce(F.max("_ends").over(earlier), F.lit(False)))
    carried = F.broadcast(_carried(placed, counted))  # a row per part at most
    boundary = F.coalesce((F.col("_page0") >= 1) & (F.col("_new0") == 0) & (F.col("_start") == 0), F.lit(False))
    known = counted.join(carried, ["_part", "query"], "left").select(
        "query",
        "page",
        (F.col("_before") + F.coalesce("_before0", F.lit(0))).alias("_before"),
        (
            F.col("_ended")
            | F.coalesce("_ended0", F.lit(False))
            | (~F.col("_first") & boundary)
        ).alias("_ended"),
    )
    read = known.where((F.col("page") == 0) | ((F.col("_before") < target) & ~F.col("_ended")))
    taken = new.join(read.select("query", "page", "_before"), order)
    in_page = F.row_number().over(Window.partitionBy(*order).orderBy("ord"))  # one page's urls
    return taken.withColumn("_r", F.col("_before") + in_page).where(F.col("_r") <= target).drop("_r", "_before")


def _carried(placed: DataFrame, counted: DataFrame) -> DataFrame:
    """What the first query of each part brings along from the parts before it.

    Only a part's first and last query can go on beyond it, so two summaries a part
    reach the driver: sum of new urls, whether paging ended inside, first and last page.
    """
    edge = F.broadcast(placed.groupBy("_part").agg(F.min("query").alias("_q0"), F.max("query").alias("_q1")))
    summaries = (
        counted.join(edge, "_part")
        .where((F.col("query") == F.col("_q0")) | (F.col("query") == F.col("_q1")))
        .groupBy("_part", "query", "_q0")
        .agg(
            F.sum("new").alias("sum"),
            F.max("_ends").alias("ends"),
            F.min_by("new", "page").alias("start"),
            F.max("page").alias("page"),
            F.max_by("new", "page").alias("new"),
        )
        .collect()
    )
    carried, state = [], None  # state of the query that the last part ended with
    for row in sorted(summaries, key=lambda r: (r["_part"], r["query"])):
        going_on = state is not None and state["query"] == row["query"]
        before, ended, ends = 0, False, bool(row["ends"])
        if going_on:
            before, ended = state["sum"], state["ended"]
            carried.append((row["_part"], row["query"], before, ended, state["page"], state["new"], row["start"]))
            ends = ends or (state["page"] >= 1 and state["new"] == 0 and row["start"] == 0)
        state = {"query": row["query"], "sum": before + row["sum"], "ended": ended or ends, "page": row["page"], "new": row["new"]}
    kind = placed.schema
    fields = (
        f"_part int, query {kind['query'].dataType.simpleString()}, _before0 bigint, _ended0 boolean, "
        "_page0 bigint, _new0 bigint, _start bigint"
    )
    return placed.sparkSession.createDataFrame(carried, fields)


def searched_links(feeds: DataFrame, search_pages: DataFrame, target: int) -> DataFrame:
    """Urls of a search whose page 0 is a feed: query, page, ord, url."""
    first = feed_links(feeds).groupBy("query").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "url"))), lambda e: e["url"]).alias("urls")
    )
    later = search_pages.select("query", "page", F.array_distinct(static_host_links(F.col("body"))).alias("urls"))
    return search_until(first.select("query", F.lit(0).alias("page"), "urls").unionByName(later), target)


def file_extension(content_type: Column) -> Column:
    return (
        F.when(F.contains(content_type, F.lit("png")), ".png")
        .when(F.contains(content_type, F.lit("webp")), ".webp")
        .otherwise(".jpg")
    )


def admitted_responses(responses: DataFrame, source: str, limit: int) -> DataFrame:
    """First ``limit`` usable responses per query with the name to store them by.

    Usable: an image content type and a body of at least ``MIN_BODY`` bytes. The
    result is slim (query, ord, url, name); bodies are joined back by (query, ord)
    where they are written, so they never pass through the ranking shuffle.
    """
    usable = responses.where(
        F.contains("content_type", F.lit("image")) & (F.octet_length("content") >= MIN_BODY)
    )
    name = F.concat(
        F.format_string(source + "_%05d_", F.col("ord")),
        N.sha256_prefix(F.col("url")),
        file_extension(F.col("content_type")),
    )
    return quota(usable.select("query", "ord", "url", name.alias("name")), limit)


def existing_counts(paths: DataFrame, path: str = "path") -> DataFrame:
    """Images on disk per (source, query slug)."""
    return (
        paths.where(N.is_image(F.col(path)))
        .groupBy(
            N.source_of_path(F.col(path)).alias("source"), N.query_of_path(F.col(path)).alias("slug")
        )
        .agg(F.count("*").alias("n"))
    )


def pending_work(
    queries: DataFrame, sources: Sequence[str], existing: DataFrame, limit: int
) -> DataFrame:
    """(source, query, slug, remaining) still short of ``limit`` images."""
    tasks = queries.select(
        F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"),
        "query",
        N.slugify(F.col("query")).alias("slug"),
    )
    have = F.coalesce("n", F.lit(0))
    return (
        tasks.join(existing, ["source", "slug"], "left")
        .where(have < limit)
        .select("source", "query", "slug", (F.lit(limit) - have).alias("remaining"))
    )


def download_totals(files: DataFrame, count: str | None = None) -> DataFrame:
    """Files per source and in total (source null).

    ``count`` names the column of file counts if a row stands for several files.
    """
    n = F.sum(count) if count else F.count("*")
    return files.rollup("source").agg(n.alias("n"))
