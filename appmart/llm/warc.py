"""WARC fixity audit with Merkle trees.

Replicas are folders of WARC files. Every record is hashed; the records of a
file are grouped into ordered ranges of its byte offsets, ranges are hashed
into a tree with a fixed fan-out, file roots into a tree over the files. Two
replicas are compared from the root: equal roots end the audit, and each
level below is compared only under nodes that differ, down to the records of
the differing ranges.

Files are read with Spark's text reader, split at record boundaries; bytes
are hashed as they are (nothing is decoded), so damaged bytes are compared
too. A payload that contains a record boundary is read as several pieces;
fixity holds all the same, as the pieces cover every byte of the file.

Defined results: a null url or html is written as an empty one; repeated rows
are records of their own; empty tables give no records and equal roots. A
file or record on one side only is ``missing`` (not in the second replica) or
``extra`` (not in the first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .store import materialise

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
RANGE_BYTES = 1 << 18
FAN_OUT = 16
WRITTEN = "2024-01-01T00:00:00Z"


def write_replica(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, html) as WARC resource records, a file per input partition."""
    html = F.coalesce("html", F.lit(""))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")
    record = F.concat(
        F.lit(VERSION + "WARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">\r\nWARC-Target-URI: "), uri,
        F.lit(f"\r\nWARC-Date: {WRITTEN}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"), F.lit(END), html)
    pages.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Per record: file (number), ordinal, at (byte offset, unpacked), length, page_id, digest (SHA-256).

    The hashes are stored once in the shared folder; the audit reads them and
    never the records again. Offsets are running sums per file, so one task
    sees the hashes (not the bytes) of one file.
    """
    raw = spark.read.option("lineSep", END + VERSION).text(path).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value"))
    # The reader drops the boundaries: all but the first record lack the version line, all but the last the end.
    whole = raw.select("file", "block", "seq", F.when(F.col("value").startswith(VERSION), F.col("value"))
                       .otherwise(F.concat(F.lit(VERSION), F.col("value"))).alias("record"))
    size, ended = F.octet_length("record").cast("long"), F.col("record").endswith(END)
    trimmed = F.expr(f"substring(cast(record as binary), 1, octet_length(record) - {len(END)})")
    hashed = whole.select(
        "file", "block", "seq",
        F.regexp_extract("record", r"\AWARC/1\.1\r\n(?:[^\r\n]+\r\n)*?WARC-Record-ID: <urn:page:(-?\d+)>", 1)
        .try_cast("long").alias("page_id"),
        size.alias("size"), F.sha2(F.col("record").cast("binary"), 256).alias("sha"), ended.alias("ended"),
        F.when(ended, F.sha2(trimmed, 256)).alias("sha_trimmed"))
    in_file = Window.partitionBy("file").orderBy("block", "seq")
    last = F.col("ended") & F.lead("seq").over(in_file).isNull()
    framed = hashed.select(
        "file", "block", "seq", "page_id", (F.col("size") + F.when(last, 0).otherwise(len(END))).alias("length"),
        F.when(last, F.col("sha_trimmed")).otherwise(F.col("sha")).alias("digest"))
    placed = framed.select(
        "file", (F.row_number().over(in_file) - 1).cast("long").alias("ordinal"),
        (F.sum("length").over(in_file) - F.col("length")).alias("at"), "length", "page_id", "digest")
    return materialise(placed, "warc-records")


def _parent(nodes: DataFrame, file_key, idx_key) -> DataFrame:
    """One level up: a node's hash covers its children's places and hashes in order."""
    child = F.struct(F.col("file"), F.col("idx"), F.col("hash"))
    kids = nodes.groupBy(file_key.alias("_f"), idx_key.alias("_i")).agg(F.sort_array(F.collect_list(child)).alias("c"))
    text = F.expr("array_join(transform(c, x -> concat_ws(':', x.file, x.idx, x.hash)), ',')")
    return kids.select(F.col("_f").alias("file"), F.col("_i").alias("idx"), F.sha2(text, 256).alias("hash"))


def range_nodes(records: DataFrame) -> DataFrame:
    """The lowest level: a node for each range of RANGE_BYTES of a file."""
    entry = F.struct("at", "length", "digest")
    ranges = records.groupBy("file", F.floor(F.col("at") / RANGE_BYTES).alias("idx")).agg(
        F.sort_array(F.collect_list(entry)).alias("c"))
    text = F.expr("array_join(transform(c, x -> concat_ws(':', x.at, x.length, x.digest)), ',')")
    return ranges.select("file", "idx", F.sha2(text, 256).alias("hash"))


def tree(records: DataFrame, range_levels: int, file_levels: int) -> list[DataFrame]:
    """All levels, lowest first: ranges, groups of FAN_OUT ranges up to one node
    per file, groups of FAN_OUT files up to one root (file 0, idx 0)."""
    levels = [materialise(range_nodes(records), "warc-tree-0")]
    for n in range(1, range_levels + file_levels + 1):
        up = (F.col("file"), F.floor(F.col("idx") / FAN_OUT)) if n <= range_levels else \
             (F.floor(F.col("file") / FAN_OUT).cast("int"), F.lit(0).cast("long"))
        levels.append(materialise(_parent(levels[-1], *up), f"warc-tree-{n}"))
    return levels


def _depth(*sides: DataFrame) -> tuple[int, int]:
    """Levels needed above the ranges, and above the files, to reach one node in either replica."""
    idx = files = 0
    for records in sides:
        top = records.agg(F.max(F.floor(F.col("at") / RANGE_BYTES)).alias("i"), F.max("file").alias("f")).first()
        idx, files = max(idx, top["i"] or 0), max(files, top["f"] or 0)
    def levels(n: int) -> int:
        steps = 0
        while n:
            n //= FAN_OUT
            steps += 1
        return steps
    return levels(idx), levels(files)


def differing_ranges(first: DataFrame, second: DataFrame) -> DataFrame:
    """(file, idx) of the ranges that differ, found by descending from the roots."""
    range_levels, file_levels = _depth(first, second)
    a, b = tree(first, range_levels, file_levels), tree(second, range_levels, file_levels)
    bad = None
    for n in range(len(a) - 1, -1, -1):
        x, y = a[n], b[n]
        if bad is not None:
            up = (F.col("file"), F.floor(F.col("idx") / FAN_OUT)) if n + 1 <= range_levels else \
                 (F.floor(F.col("file") / FAN_OUT).cast("int"), F.lit(0).cast("long"))
            under = bad.select(F.col("file").alias("_f"), F.col("idx").alias("_i"))
            on = [F.col("_f") == up[0], F.col("_i") == up[1]]
            x, y = x.join(under, on, "left_semi"), y.join(under, on, "left_semi")
        both = x.join(y.withColumnRenamed("hash", "other"), ["file", "idx"], "full")
        bad = materialise(both.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "idx"), f"warc-bad-{n}")
        if bad.isEmpty():
            break
    return bad


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Every record of the first replica, and extra ones of the second:
    file, at, length, page_id, digest, status (ok, corrupt, missing, extra)."""
    bad = differing_ranges(first, second).select("file", F.col("idx").alias("range"))
    def in_range(r: DataFrame) -> DataFrame:
        return r.withColumn("range", F.floor(F.col("at") / RANGE_BYTES))
    fine = in_range(first).join(bad, ["file", "range"], "left_anti").select(
        "file", "at", "length", "page_id", "digest", F.lit("ok").alias("status"))
    a = in_range(first).join(bad, ["file", "range"], "left_semi").alias("a")
    b = in_range(second).join(bad, ["file", "range"], "left_semi").alias("b")
    pair = a.join(b, (F.col("a.file") == F.col("b.file")) & (F.col("a.at") == F.col("b.at")), "full")
    status = (F.when(F.col("b.file").isNull(), "missing").when(F.col("a.file").isNull(), "extra")
              .when((F.col("a.digest") == F.col("b.digest")) & (F.col("a.length") == F.col("b.length")), "ok")
              .otherwise("corrupt"))
    compared = pair.select(*[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)
                             for c in ("file", "at", "length", "page_id", "digest")], status.alias("status"))
    return fine.unionByName(compared)
