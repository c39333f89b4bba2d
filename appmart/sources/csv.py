"""Fixed-schema CSV sources (A1, A2).

Columns bind by position to a declared schema; headers are skipped, never
trusted, and nothing is inferred. Malformed rows fail the job. An absent text
(``,,``) is NULL, a quoted empty one (``,"",``) is the empty text; an empty number is
NULL either way. Spark's CSV
reader only parses the columns a query needs, so a bad value in an unread
column surfaces when the full-width table is written — which is why the
pipeline writes the raw table first and counts the written copy.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands for a missing value while a line is parsed. A quoted empty value is parsed as '' and
#: an absent one as this text, so the two stay apart; it holds a control character and no data should.
MISSING = "\u0001missing\u0001"

CSV_READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "FAILFAST",
    "escape": '"',
    "multiLine": "false",
    "nullValue": MISSING,
    "emptyValue": "",
}

CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    # Keep blanks around values: they are part of the data the keys normalise.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Scan CSV file(s) with a declared schema, one header row, strict parsing."""
    reader = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]))
    for key, value in CSV_READ_OPTIONS.items():
        reader = reader.option(key, value)
    texts = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    return texts.select(*[_typed(f) for f in schema.fields])


def _typed(field: T.StructField) -> Column:
    """The value of a column of texts; one that is not of the type fails the job, whatever the session's settings."""
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text
    value = text.try_cast(field.dataType)
    wrong = F.concat(F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "), text)
    return (F.when(text == "", F.lit(None)).when(text.isNotNull() & value.isNull(), F.raise_error(wrong))
            .otherwise(value).cast(field.dataType).alias(field.name))


def write_csv(df: DataFrame, path: str) -> str:
    """Write ``df`` as a folder of CSV part files (with header), in parallel."""
    writer = df.write.mode("overwrite")
    for key, value in CSV_WRITE_OPTIONS.items():
        writer = writer.option(key, value)
    writer.csv(path)
    return path


#: A source is named after its table: ``name.csv``, compressed or not, one file or a folder of part files.
_SOURCE_NAME = re.compile(r"([^.]+)(\.[^/]+)?\.csv(\.(gz|bz2|zst|lz4|snappy|deflate))?", re.IGNORECASE)
_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?")


def relative_path(root: str, path: str) -> str:
    """``path`` below ``root``; either may carry a scheme and host, or leave the default ones out."""
    base, full = (posixpath.normpath(_SCHEME.sub("", p) or "/") for p in (root, path))
    inside = posixpath.relpath(full, base)
    if inside == ".." or inside.startswith("../"):
        raise ValueError(f"{path} is not below {root}")
    return inside


def table_name_of(relative: str) -> str | None:
    """Table name of a source from its top-level entry; None if that is not a CSV source."""
    found = _SOURCE_NAME.fullmatch(relative.strip("/").split("/", 1)[0])
    return found.group(1) if found else None


def list_sources(spark: SparkSession, directory: str) -> dict[str, tuple[str, int]]:
    """Map each top-level entry of ``directory`` → (path, size in bytes).

    A file-metadata scan (the binary-file source reads no content when only
    path and length are selected). Sizes are summed on the executors; one row
    per entry comes back, however many part files a folder holds. Hidden
    files (``_`` or ``.`` first) are not listed.
    """
    root = directory.rstrip("/")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(root)
    root = folder.getFileSystem(conf).makeQualified(folder).toString()
    entries = {relative_path(root, e.getPath().toString()): e.getPath().toString()
               for e in folder.getFileSystem(conf).listStatus(folder)
               if not e.getPath().getName().startswith(("_", "."))}
    if not entries:
        return {}
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select(F.split(F.regexp_replace(F.col("path"), _SCHEME.pattern, ""), "/").alias("parts"), "length"))
    depth = len([p for p in _SCHEME.sub("", root).split("/") if p]) + 1
    sizes = {r["entry"]: r["size"] for r in listing.groupBy(F.element_at("parts", depth + 1).alias("entry")).agg(
        F.sum("length").alias("size")).collect()}
    return {entry: (path, int(sizes.get(entry) or 0)) for entry, path in sorted(entries.items())}


def discover_sources(spark: SparkSession, directory: str, tables: Collection[str],
                     optional: Collection[str] = ()) -> dict[str, tuple[str, int]]:
    """Map each of ``tables`` → (path, size) of its source below ``directory``.

    Anything else there, two sources for one table, or a missing table that is
    not in ``optional`` is an error: nothing is skipped or taken as empty.
    """
    found: dict[str, tuple[str, int]] = {}
    wrong = []
    for entry, source in list_sources(spark, directory).items():
        name = table_name_of(entry)
        if name not in tables or name in found:
            wrong.append(entry)
        else:
            found[name] = source
    missing = sorted(set(tables) - set(found) - set(optional))
    if wrong or missing:
        raise ValueError(f"sources in {directory}: not recognised {sorted(wrong)}, missing {missing}")
    return found
