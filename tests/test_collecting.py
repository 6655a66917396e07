"""Names, harvest, resolution lookups, monitoring and browsing."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.functions import names as N
from spark_curate.functions import vectors as V
from spark_curate.operators import export, harvest, monitor, resolution
from spark_curate.plans import steps


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "path,canonical,resized",
    [
        ("a.jpg", "a.jpg", hashlib.md5(b".").hexdigest()[:8] + "_a"),
        ("x/y/a.b.JPG", hashlib.md5(b"x/y").hexdigest()[:8] + "_a.b.JPG", hashlib.md5(b"x/y").hexdigest()[:8] + "_a.b"),
        ("x/.hidden", hashlib.md5(b"x").hexdigest()[:8] + "_.hidden", hashlib.md5(b"x").hexdigest()[:8] + "_.hidden"),
    ],
)
def test_file_names(spark, path, canonical, resized):
    assert one(spark, N.canonical_name(F.col("p")), p=path) == canonical
    assert one(spark, N.resized_name(F.col("p")), p=path) == resized


def test_path_pieces(spark):
    p = F.col("p")
    assert one(spark, N.suffix(p), p="q/.png") == ""
    assert one(spark, N.is_image(p), p="q/x.JPEG") and not one(spark, N.is_image(p), p="q/x.txt")
    assert one(spark, N.relative_path(p, "/r/"), p="/r/a/b.png") == "a/b.png"
    assert one(spark, N.relative_path(p, "/r"), p="/s/b.png") == "b.png"
    for path, want in (("a/b/c.png", ("a", "b")), ("a/c.png", ("a", None)), ("c.png", (None, None))):
        assert (one(spark, N.source_of_path(p), p=path), one(spark, N.query_of_path(p), p=path)) == want
    for name, want in (("h_Image_1.jpg", "bing"), ("h_google_1_x", "google"), ("h_x", "unknown")):
        assert one(spark, N.source_of_name(p), p=name) == want


def test_slugs_and_hashes(spark):
    q = F.col("q")
    assert one(spark, N.slugify(q), q="  Red  Clay_(Été)! ") == "red_clay_été"
    assert one(spark, N.slugify(q), q="_a-b_") == "a-b"
    assert one(spark, N.tag_list(q), q="a b") == "a,b"
    assert one(spark, N.encoded_query(q), q="a b&c") == "a+b%26c"
    assert one(spark, N.encoded_query(q), q="~a*b é/_.-") == "~a%2Ab+%C3%A9%2F_.-"
    for text, want in (("ff", 255), ("ffffffffffffffff", -1), ("8000000000000000", -(2**63)), ("xyz", None), ("", None), ("1" * 17, None)):
        assert one(spark, N.hash_from_hex(q), q=text) == want


def test_numbers_and_maps(spark):
    c = F.col("c")
    for text, want in ((" 1.5 ", 1.5), ("N/A", None), ("NaN", None), ("", None), ("x", None)):
        assert one(spark, C.tolerant_double(c), c=text) == want
    assert one(spark, C.percent_text(c), c=0.1234) == "12.3%"
    assert one(spark, C.four_places(c.cast("double")), c=None) == "N/A"
    assert one(spark, C.title_words(c), c="red_clay") == "Red Clay"
    merged = C.merge_maps(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3)))
    assert one(spark, merged, c=0) == {"a": 1, "b": 3}
    assert one(spark, V.unit(F.array(F.lit(0.0))), c=0) is None
    assert one(spark, V.euclidean(F.array(F.lit(0.0), F.lit(3.0)), F.array(F.lit(4.0), F.lit(0.0))), c=0) == 5.0


def test_page_links(spark):
    html = (
        '"https://a.com/x.JPG?s=1" ["https://a.com/y.png"] "https://a.com/x.JPG?s=1" "https://www.gstatic.com/z.jpg" '
        '"https://a.com/page.html" "https://a.com/' + "l" * 1990 + '.jpg" "http://b.com/w.webp"'
    )
    pages = spark.createDataFrame([(1, "https://b.com/p", html)], "page_id int, url string, html string")
    got = [r["url"] for r in harvest.page_links(pages).orderBy("ord").collect()]
    assert got == ["https://a.com/x.JPG?s=1", "https://a.com/y.png", "http://b.com/w.webp"]
    assert harvest.page_links(pages, limit=2).count() == 2
    away = harvest.page_links(pages, harvest.LinkRules(skip_same_host=True))
    assert "http://b.com/w.webp" not in [r["url"] for r in away.collect()]


def plain_search(pages, target):
    seen, urls, empty, page = set(), [], 0, 1
    for u in pages.get(0, []):
        if u not in seen:
            seen.add(u)
            urls.append(u)
    while len(urls) < target and page in pages:
        new = 0
        for u in pages[page]:
            if u not in seen:
                seen.add(u)
                urls.append(u)
                new += 1
        empty = 0 if new else empty + 1
        if empty >= 2:
            break
        page += 1
    return urls[:target]


def test_search_until(spark):
    queries = {
        "stops": {0: ["a"], 1: ["b"], 2: ["a"], 3: ["b"], 4: ["late"]},
        "recovers": {0: ["a"], 1: ["a"], 2: ["b", "c"], 3: [], 4: ["d"]},
        "target": {0: ["a", "b"], 1: ["c", "d"], 2: ["e", "f"], 3: ["g"]},
        "feed": {0: list("abcdefgh"), 1: ["x"]},
        "nofeed": {1: ["a"], 2: ["b"]},
        "first empty": {0: [], 1: [], 2: [], 3: ["x"]},
    }
    rows = [(q, p, urls) for q, pages in queries.items() for p, urls in pages.items()]
    df = spark.createDataFrame(rows, "query string, page int, urls array<string>")
    found = harvest.search_until(df, 5).collect()
    for query, pages in queries.items():
        mine = [r["url"] for r in sorted(found, key=lambda r: (r["page"], r["ord"])) if r["query"] == query]
        assert mine == plain_search(pages, 5), query


def test_feed(spark):
    rows = [
        ("q", '{"items":[{"media":{"m":"u1_m.jpg"}},{"media":{"m":"u1_m.jpg"}},{"media":{}},{},{"media":{"m":"u2_m.jpg"}}]}'),
        ("bad", "{oops"), ("none", "{}"),
    ]
    got = [tuple(r) for r in harvest.feed_links(spark.createDataFrame(rows, "query string, body string")).collect()]
    assert sorted(got) == [("q", 0, "u1_b.jpg"), ("q", 1, "u2_b.jpg")]


def test_admission(spark):
    rows = [
        ("q", 0, "u0", "image/png", b"x" * 999), ("q", 1, "u1", "image/png", b"x" * 1000),
        ("q", 2, "u2", "text/html", b"x" * 5000), ("q", 3, "u3", "image/webp; q", b"x" * 1000),
        ("q", 4, "u4", "image/jpeg", b"x" * 1000),
    ]
    df = spark.createDataFrame(rows, "query string, ord int, url string, content_type string, content binary")
    got = [r["name"] for r in harvest.admitted_responses(df, "google", 2).orderBy("ord").collect()]
    h = [hashlib.sha256(u).hexdigest()[:16] for u in (b"u1", b"u3")]
    assert got == [f"google_00001_{h[0]}.png", f"google_00003_{h[1]}.webp"]


def test_pending_work(spark):
    queries = spark.createDataFrame([("Red Clay",), ("sand",)], "query string")
    paths = spark.createDataFrame([("google/red_clay/1.jpg",), ("google/red_clay/2.gif",), ("google/red_clay/t.txt",), ("bing/sand/1.jpg",)], "path string")
    have = harvest.existing_counts(paths)
    got = {(r["source"], r["query"], r["remaining"]) for r in harvest.pending_work(queries, ("google", "bing"), have, 2).collect()}
    assert got == {("google", "sand", 2), ("bing", "Red Clay", 2), ("bing", "sand", 1)}


def test_originals(spark):
    raw = spark.createDataFrame([("g/q/a.png",), ("g/q/a.jpg",), ("g/q/b.gif",), ("g/x.jpg",)], "path string")
    names = raw.select(N.resized_name(F.col("path")).alias("n")).distinct()
    got = {r["image"]: r["path"] for r in resolution.find_originals(names.select(F.concat("n", F.lit(".jpg")).alias("image")), raw).collect()}
    assert sorted(v or "" for v in got.values()) == ["", "", "g/q/a.jpg"]
    assert [tuple(r)[1:] for r in resolution.name_collisions(raw).collect()] == [(2, "g/q/a.jpg")]


def counts(spark, **n):
    return spark.createDataFrame([(s, i, v) for i, (s, v) in enumerate(n.items())], "step string, step_ord int, n bigint")


def test_funnel_and_alarms(spark):
    rows = monitor.funnel(counts(spark, download=100, resize=0, dedup=5, filter=1, cluster=0), not_run=["cluster"])
    got = {r["to_step"]: r["conversion_pct"] for r in rows.collect()}
    assert got == {"resize": 0.0, "dedup": None, "filter": 20.0, "cluster": None}
    rates = spark.createDataFrame([("filter", 1, 3), ("dedup", 50, 50)], "step string, kept bigint, removed bigint")
    alarms = {(r["severity"], r["rule"], r["step"]) for r in monitor.anomalies(rows, rates).collect()}
    assert alarms == {("high", "retention", "resize"), ("high", "retention", "filter"), ("warn", "removal", "dedup")}


def test_inputs_and_readiness(spark):
    c = counts(spark, download=9, resize=0, dedup=0)
    assert tuple(monitor.first_input(c, ("dedup", "resize", "download")).first()) == ("download", 9)
    assert monitor.first_input(c, ("dedup", "resize")).count() == 0
    have = spark.createDataFrame([("raw", 5), ("labels", 3), ("embeddings", 0)], "artifact string, n bigint")
    got = {r["step"]: (r["ready"], r["used"], r["missing"], r["run_first"]) for r in monitor.readiness(spark, have).collect()}
    assert got["download"] == (True, None, [], None)
    assert got["label"] == (True, "raw", [], None)
    assert got["eval-report"] == (False, "labels", ["eval_sample"], "eval-sample")
    assert got["cluster-review"][2:] == (["embeddings", "eval_sample", "eval_metrics"], "label")
    nothing = {r["step"]: r for r in monitor.readiness(spark, have.where("false")).collect()}
    assert nothing["dedup"]["missing"] == ["resized", "raw"] and nothing["dedup"]["run_first"] == "download"


def test_corrections(spark):
    labels = spark.createDataFrame([("a", "x", "u"), ("b", "x", "u")], "image string, c string, d string")
    fixes = spark.createDataFrame(
        [("a", False, 1, "y", "v"), ("a", False, 2, "z", None), ("a", True, 3, "q", "q"), ("b", None, 1, "q", "q")],
        "image string, correct boolean, ord int, c string, d string",
    )
    got = {r["image"]: (r["c"], r["d"], r["corrected"]) for r in export.apply_corrections(labels, fixes, ("c", "d")).collect()}
    assert got == {"a": ("z", "u", True), "b": ("x", "u", False)}


def test_fallback_tables(spark):
    full, none = spark.range(3), spark.range(0)
    assert monitor.coalesce_tables(full, none).count() == 3
    assert monitor.coalesce_tables(none, full).count() == 3


def test_paging_over_gaps_in_the_numbers(spark):
    pages = spark.createDataFrame(
        [("q", p, [f"u{p}"]) for p in (0, 10, 20, 30)] + [("r", p, ["same"]) for p in (0, 5, 9, 40)] + [("r", 50, ["late"])],
        "query string, page int, urls array<string>",
    )
    got = sorted((r["query"], r["page"], r["url"]) for r in harvest.search_until(pages, 3).collect())
    assert got == [("q", 0, "u0"), ("q", 10, "u10"), ("q", 20, "u20"), ("r", 0, "same")]


def searched_plainly(pages, target):
    out = []
    for query in {q for q, _, _ in pages}:
        seen, before, ended, last = set(), 0, False, None
        for page, urls in sorted((p, u) for q, p, u in pages if q == query):
            new = [u for k, u in enumerate(urls) if u not in seen and u not in urls[:k]]
            seen.update(urls)
            if page == 0 or (before < target and not ended):
                out += [(query, page, urls.index(u), u) for k, u in enumerate(new) if before + k < target]
            ended = ended or (last is not None and last[0] >= 1 and not new and last[1] == 0)
            before, last = before + len(new), (page, len(new))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_search_over_parts_is_the_plain_rule(spark, seed):
    """One query of most pages over many parts, empty runs across their borders."""
    rng = random.Random(seed)
    pages = []
    for query, n in (("hot", 60), ("a", 5), ("b", 3), ("zz", 12)):
        numbers = sorted(rng.sample(range(0, 3 * n), n))
        for page in numbers:
            urls = [f"u{rng.randrange(40 if seed % 2 else 400)}" for _ in range(rng.choice((0, 0, 1, 3)))]
            pages.append((query, page, urls))
    df = spark.createDataFrame(pages, "query string, page int, urls array<string>")
    for target in (7, 25, 1000):
        for parts in (None, 9, 40):
            found = harvest.search_until(df, target, parts)
            assert sorted((r["query"], r["page"], r["ord"], r["url"]) for r in found.collect()) == searched_plainly(pages, target)
    plan = harvest.search_until(df, 25)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(query#\d+, \d", plan), "no exchange by the query alone"


def test_harvest_of_both_kinds_of_search(spark):
    """Result pages fill a threefold quota; feeds and paged searches stop at 1.4 times it."""
    queries = spark.createDataFrame([("red",), ("blue",)], "query string")
    paths = spark.createDataFrame([(f"flickr/blue/x_{i}.jpg",) for i in range(5)], "path string")
    image = lambda i: f'"https://a.example/{i}.jpg"'
    pages = spark.createDataFrame([(1, "red", "http://s", " ".join(map(image, range(40))))], "page_id long, query string, url string, html string")
    feed = '{"items": [{"media": {"m": "https://live.example/f1_m.jpg"}}, {"media": {"m": "https://live.example/f2_m.jpg"}}]}'
    feeds = spark.createDataFrame([("red", feed), ("blue", feed)], "query string, body string")
    photo = lambda n: f"live.staticflickr.com/{n}_z.jpg"
    found = [("red", 1, f"{photo('a')} {photo('b')} {photo('a')}"), ("red", 2, f"{photo('c')} {photo('d')}"), ("red", 3, photo("e")), ("red", 4, photo("g")), ("blue", 1, photo("a"))]
    search = spark.createDataFrame(found, "query string, page int, body string")
    responses = spark.createDataFrame(
        [("red", 0, "u0", "image/png", b"x" * 2000), ("red", 1, "u1", "text/html", b"x" * 2000), ("red", 2, "u2", "image/jpeg", b"x")],
        "query string, ord int, url string, content_type string, content binary",
    )
    out = steps.harvest_step(queries, ["flickr"], paths, pages, 5, feeds=feeds, search_pages=search, responses=responses)
    assert out["links"].where("query = 'red'").count() == 15
    got = sorted((r["page"], r["ord"], r["url"]) for r in out["search_links"].collect())
    assert [u.split("/")[-1] for _, _, u in got] == ["f1_b.jpg", "f2_b.jpg", "a_b.jpg", "b_b.jpg", "c_b.jpg", "d_b.jpg", "e_b.jpg"]
    assert [r["url"] for r in out["admitted"].collect()] == ["u0"] and {r["query"] for r in out["search_links"].collect()} == {"red"}


def test_harvest_totals_count_files(spark):
    paths = spark.createDataFrame([(f"google/red/google_{i}.jpg",) for i in range(5)], "path string")
    queries = spark.createDataFrame([("red",)], "query string")
    pages = spark.createDataFrame([], "page_id long, query string, url string, html string")
    totals = {r["source"]: r["n"] for r in steps.harvest_step(queries, ["google"], paths, pages, 9)["totals"].collect()}
    assert totals == {"google": 5, None: 5}
