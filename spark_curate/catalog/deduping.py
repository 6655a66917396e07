"""Queries on hashes, near duplicates and their groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from spark_curate.catalog import inputs as I
from spark_curate.functions.session import materialize
from spark_curate.operators import dedup, monitor

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def document_hashes(spark, sf_dir):
    """Documents by name, hashed so that near copies stay near.

    A word flips the bit its own hash names: equal texts share their hash, and each
    word changed, added or left out moves two bits at most. The operators read the
    hashes several times, so they are written once.
    """
    name = F.concat_ws("_", F.lit("doc"), "source", F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    bit = F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("bigint") % 64
    flip = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int"))
    words = I.table(spark, sf_dir, "documents").select(
        "doc_id", name.alias("image"), F.explode(F.split("text", " ")).alias("w")
    )
    hashed = words.groupBy("doc_id", "image").agg(F.bit_xor(flip).alias("phash"))
    return materialize(hashed.select("image", "phash"))


DOC_HASHES = """SELECT 'doc_' || source || '_' || printf('%012d', doc_id) AS image,
  (CASE WHEN u >= 9223372036854775808 THEN u - 18446744073709551616 ELSE u END)::BIGINT AS phash
  FROM (SELECT doc_id, any_value(source) AS source,
          bit_xor(1::UBIGINT << (('0x' || substr(md5(w), 1, 8))::BIGINT % 64)::UBIGINT)::HUGEINT AS u
        FROM (SELECT doc_id, source, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY doc_id)"""


def greedy_sql(body, source, threshold, *names):
    """The sequential rule as a recursion over the ordered distinct hashes."""
    return I.sql(
        body,
        *names,
        recursive=True,
        extra={
            "h": source,
            "reps": """SELECT phash, min(image) AS image, row_number() OVER (ORDER BY min(image)) AS rk
                       FROM h GROUP BY phash""",
            "walk(rk, kept, keeper)": f"""SELECT 0::BIGINT, []::STRUCT(i BIGINT, p BIGINT)[], NULL::BIGINT
              UNION ALL
              SELECT w.rk + 1, CASE WHEN hit IS NULL THEN list_append(w.kept, {{'i': r.rk, 'p': r.phash}})
                                    ELSE w.kept END, hit
              FROM walk w JOIN reps r ON r.rk = w.rk + 1,
              LATERAL (SELECT list_filter(w.kept, lambda k: bit_count(xor(k.p, r.phash)) <= {threshold})[1].i AS hit)""",
            "dups": """SELECT h.image, k.image AS duplicate_of FROM h JOIN reps r ON h.phash = r.phash
              JOIN walk w ON w.rk = r.rk JOIN reps k ON k.rk = coalesce(w.keeper, r.rk)
              WHERE h.image <> k.image""",
        },
    )


@register(
    "hamming_pairs",
    I.sql(
        """SELECT a.image AS image_a, b.image AS image_b, bit_count(xor(a.phash, b.phash))::INT AS distance
        FROM reps a JOIN reps b ON a.image < b.image
        WHERE bit_count(xor(a.phash, b.phash)) <= 10""",
        extra={"h": DOC_HASHES, "reps": "SELECT phash, min(image) AS image FROM h GROUP BY phash"},
    ),
)
def hamming_pairs(spark, sf_dir):
    return dedup.near_pairs(document_hashes(spark, sf_dir), 10)


@register(
    "duplicates",
    greedy_sql("SELECT * FROM dups", "SELECT image, phash FROM hashes", I.DUP_BITS, "hashes"),
)
def duplicates(spark, sf_dir):
    return dedup.find_duplicates(I.hashes(spark, sf_dir), I.DUP_BITS)


@register(
    "dedup_survivors",
    greedy_sql("SELECT image FROM h WHERE image NOT IN (SELECT image FROM dups)", DOC_HASHES, 10),
)
def dedup_survivors(spark, sf_dir):
    hashes = document_hashes(spark, sf_dir)
    return dedup.survivors(hashes, dedup.find_duplicates(hashes, 10)).select("image")


@register("document_duplicates", greedy_sql("SELECT * FROM dups", DOC_HASHES, 10))
def document_duplicates(spark, sf_dir):
    return dedup.find_duplicates(document_hashes(spark, sf_dir), 10)


@register(
    "document_dedup_counts",
    greedy_sql(
        """SELECT (SELECT count(*) FROM h) AS total, count(*) AS removed,
        (SELECT count(*) FROM h) - count(*) AS kept FROM dups""",
        DOC_HASHES,
        10,
    ),
)
def document_dedup_counts(spark, sf_dir):
    hashes = document_hashes(spark, sf_dir)
    return dedup.dedup_counts(hashes, dedup.find_duplicates(hashes, 10))


@register(
    "dedup_source_stats",
    greedy_sql(
        """SELECT split_part(h.image, '_', 2) AS source,
        count(*) FILTER (d.image IS NULL) AS kept, count(d.image) AS removed
        FROM h LEFT JOIN dups d ON d.image = h.image GROUP BY 1""",
        DOC_HASHES,
        10,
    ),
)
def dedup_source_stats(spark, sf_dir):
    hashes = document_hashes(spark, sf_dir)
    return monitor.dedup_stats(hashes, dedup.find_duplicates(hashes, 10))




@register(
    "duplicate_groups",
    greedy_sql(
        """SELECT duplicate_of, piece, string_agg(image, ',' ORDER BY image) AS removed FROM (
        SELECT image, d.duplicate_of, CASE WHEN n > 2
          THEN ('0x' || substr(md5(image), 1, 8))::BIGINT % ceil(n / 2)::BIGINT ELSE 0 END AS piece
        FROM dups d JOIN (SELECT duplicate_of, count(*) AS n FROM dups GROUP BY 1) s
        ON s.duplicate_of = d.duplicate_of) GROUP BY 1, 2""",
        DOC_HASHES,
        10,
    ),
)
def duplicate_groups(spark, sf_dir):
    dups = dedup.find_duplicates(document_hashes(spark, sf_dir), 10)
    groups = dedup.duplicate_groups(dups, piece_rows=2)
    return groups.withColumn("removed", F.array_join("removed", ","))


@register(
    "duplicate_lookup",
    greedy_sql(
        """SELECT image, duplicate_of, count(*) OVER (PARTITION BY duplicate_of) - 1 AS siblings FROM dups""",
        DOC_HASHES,
        10,
    ),
)
def duplicate_lookup(spark, sf_dir):
    return dedup.duplicate_lookup(dedup.find_duplicates(document_hashes(spark, sf_dir), 10))


@register(
    "removed_names",
    greedy_sql("SELECT DISTINCT image FROM dups", DOC_HASHES, 10),
)
def removed_names(spark, sf_dir):
    hashes = document_hashes(spark, sf_dir)
    dups = dedup.find_duplicates(hashes, 10)
    groups = dedup.duplicate_groups(dups)
    return dedup.removed_names(groups, hashes, dedup.survivors(hashes, dups))


@register(
    "removed_by_difference",
    I.sql(
        "SELECT image FROM items EXCEPT SELECT image FROM decisions WHERE kept", "items", "decisions"
    ),
)
def removed_by_difference(spark, sf_dir):
    everything = I.items(spark, sf_dir)
    none = everything.where(F.lit(False)).select(
        F.col("image").alias("duplicate_of"), F.array("image").alias("removed")
    )
    return dedup.removed_names(none, everything, I.decisions(spark, sf_dir).where("kept"))
