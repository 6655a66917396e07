"""Names, paths, slugs and url pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffixes taken as images, in listing order.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "webp", "bmp", "tiff", "tif", "gif")

# Suffixes a step listing shows, also the order in which a stem
# is looked up.
LISTED_SUFFIXES = ("jpg", "jpeg", "png", "webp")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_path(path: Column) -> Column:
    """Everything before the last slash; empty at the root."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def suffix(path: Column) -> Column:
    """Lower-case suffix without its dot; empty if there is none."""
    return F.lower(F.regexp_extract(file_name(path), r".\.([^.]*)$", 1))


def stem(path: Column) -> Column:
    """Name without its suffix; a leading or a trailing dot makes no suffix."""
    return F.regexp_replace(file_name(path), r"(.)\.[^.]+$", "$1")


def relative_path(path: Column, root: str) -> Column:
    """``path`` below ``root``; the bare file name if it lies elsewhere."""
    root = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(root)), F.substr(path, F.lit(len(root) + 1))).otherwise(
        file_name(path)
    )


def is_image(path: Column, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> Column:
    return suffix(path).isin(*suffixes)


def md5_prefix(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 8)


def sha256_prefix(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def canonical_name(path: Column) -> Column:
    """Stable flat name: nested files carry a hash of their parent path."""
    parent = parent_path(path)
    return F.when(parent.isin("", "."), file_name(path)).otherwise(
        F.concat(md5_prefix(parent), F.lit("_"), file_name(path))
    )


def resized_name(path: Column) -> Column:
    """Name in the resize step: always prefixed (``.`` at the root), no suffix."""
    parent = parent_path(path)
    token = F.when(parent == "", F.lit(".")).otherwise(parent)
    return F.concat(md5_prefix(token), F.lit("_"), stem(path))


def source_of_name(name: Column) -> Column:
    """``hash_source_rest`` -> source; ``Image`` means ``bing``."""
    parts = F.split(name, "_")
    token = F.try_element_at(parts, F.lit(2))
    return (
        F.when(F.size(parts) < 3, F.lit("unknown"))
        .when(token == "Image", F.lit("bing"))
        .otherwise(token)
    )


def source_of_path(path: Column) -> Column:
    """First folder of a raw path, null for a bare file."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(1)))


def query_of_path(path: Column) -> Column:
    """Second folder of a raw path, null for shallower paths."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(2)))


def slugify(text: Column) -> Column:
    """Folder-safe form of a query: words joined by single underscores."""
    cleaned = F.regexp_replace(F.trim(F.lower(text)), r"(?U)[^\w\s-]", "")
    return F.btrim(F.regexp_replace(cleaned, r"(?U)[\s_]+", "_"), F.lit("_"))


def tag_list(query: Column) -> Column:
    return F.replace(query, F.lit(" "), F.lit(","))


def encoded_query(query: Column) -> Column:
    """A query as url text: blanks as plus signs, ``~`` as it is, ``*`` escaped."""
    return F.replace(F.replace(F.url_encode(query), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def url_host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def hash_from_hex(text: Column) -> Column:
    """Up to 16 hex digits to a signed 64-bit hash; anything else is null."""
    digits = F.trim(text)
    return F.when(
        digits.rlike(r"^[0-9a-fA-F]{1,16}$"),
        F.conv(digits, 16, -10).try_cast("bigint"),
    )
