"""Reference pictures of watchlist entries (SRC6, SRC7, FN10, FN11, JOB9)."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.functions.columns import safe_ratio
from gatewatch.functions.image_size import image_size

# Picture kinds, the watchlist column holding each kind's
# object key, and the display scaling target (height 50 for body and back
# pictures, width 350 for plate pictures).
PICTURE_KINDS = (
    ("body", "img_body", "height", 50),
    ("plate", "img_plate", "width", 350),
    ("back", "img_back", "height", 50),
)
LISTED = 10_000  # wanted file names that go into the scan as a predicate


def picture_keys(df: DataFrame) -> DataFrame:
    """Distinct (kind, key) of the non-empty picture keys in ``df``'s
    img_body/img_plate/img_back columns. One scan: the three columns are
    unpivoted with a generator, not a union."""
    arr = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(col).alias("key")) for kind, col, _, _ in PICTURE_KINDS]
    )
    return (
        df.select(F.inline(arr))
        .where(F.col("key").isNotNull() & (F.col("key") != ""))
        .distinct()
    )


def picture_names(df: DataFrame) -> DataFrame:
    """(kind, key, name) where name is the key without its ``kind/`` folder (FN10)."""
    k = picture_keys(df)
    return k.select(
        "kind", "key", F.replace(F.col("key"), F.concat(F.col("kind"), F.lit("/")), F.lit("")).alias("name")
    )


def _files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)


def _sizes(files: DataFrame) -> DataFrame:
    sized = files.select(_key_of(F.col("path")).alias("key"), image_size(F.col("content")).alias("size"))
    return sized.where("size IS NOT NULL").select("key", "size.width", "size.height")


def read_pictures(spark: SparkSession, root: str) -> DataFrame:
    """(key, width, height) of every picture under ``root`` (SRC6 + SRC7), by
    its file header. Keys have the form ``kind/file``, so the key is the last
    two segments of the path. Files of no known picture form are left out."""
    return _sizes(_files(spark, root))


def _key_of(path_col) -> "F.Column":
    return F.regexp_extract(path_col, r"([^/]+/[^/]+)$", 1)


def _spellings(name: str) -> set[str]:
    """How a file's name may stand in its metadata: as a URI, in which other
    than ASCII characters may or may not be escaped, or as it is."""
    legal = "_-!.~'()*,;:$&+=@"
    return {name, quote(name, safe=legal), "".join(c if ord(c) > 127 else quote(c, safe=legal) for c in name)}


def read_pictures_for(spark: SparkSession, root: str, keys: DataFrame, listed: int = LISTED) -> DataFrame:
    """(key, width, height) of the pictures under ``root`` whose key is in
    ``keys["key"]``; no other file's header is looked at.

    A report has some thousand pictures of a store of millions: up to
    ``listed`` distinct file names go into the scan as a predicate on the file's
    name, by which the planner leaves the other files out, so they are never
    opened. Beyond that the scan opens every file. In both cases a semi join on
    the whole key stands between the scan and the reading of headers.
    """
    names = keys.where("key IS NOT NULL").select(F.element_at(F.split("key", "/"), -1).alias("name")).distinct()
    files = _files(spark, root)
    few = names.limit(listed + 1).collect()
    if len(few) <= listed:
        files = files.where(F.col("_metadata.file_name").isin(sorted({x for r in few for x in _spellings(r.name)})))
    wanted = keys.select(F.col("key").alias("_key")).distinct()
    return _sizes(files.join(wanted, _key_of(F.col("path")) == F.col("_key"), "left_semi"))


def picture_table(keys: DataFrame, pictures: DataFrame) -> DataFrame:
    """key, name, width, height, scale for the wanted keys (JOB9). A key
    without a readable picture keeps NULL size and scale."""
    k = picture_names(keys) if "kind" not in keys.columns else keys
    p = pictures.select(F.col("key").alias("_pkey"), "width", "height")
    j = k.join(p, k["key"] == p["_pkey"], "left")
    scale = None
    for kind, _, dim, target in PICTURE_KINDS:
        term = safe_ratio(target, F.col(dim))
        scale = F.when(F.col("kind") == kind, term) if scale is None else scale.when(F.col("kind") == kind, term)
    return j.select(
        "key",
        "name",
        F.col("width").cast("int").alias("width"),
        F.col("height").cast("int").alias("height"),
        scale.alias("scale"),
    )
