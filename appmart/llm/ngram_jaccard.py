"""Exact Jaccard self-join of documents on word n-gram sets, with set-relation skipping.

Texts with equal sets form one node. Nodes are indexed by the prefix of their
set under one global order (common shingles last), as similar sets must meet
in a prefix list. Two relations among sets keep the lists from being paired out:

* Index skipping. A list entry carries its position. A pair can only reach
  the needed overlap if enough of both sets lies behind the positions, and
  only sizes within the ratio can match; lists are cut into blocks by size
  and position, and block pairs that cannot qualify are never opened.
* Answer skipping. A long list is answered for its leader first (the entry
  with fewest rare shingles, as a rule the text that the others vary, and the
  same one in all lists of its near copies). A set close to a leader is anchored to it
  and keeps only its difference. For two sets with the same anchor the
  overlap follows from the leader's answer and the two differences, so such
  pairs leave the lists and are found by a prefix join on the differences;
  pairs both linked to the anchor need no answer of their own for components.
  Numbers of links need them: pairs whose differences are too small to matter
  are counted by size of set and difference, the others compared.

Everything else about a pair is exact: count sketches give a lower bound of
the difference and drop hopeless candidates without loss, the rest is
verified on the sets.

Defined results: null, empty and blank texts have no shingles and are linked
with nothing (their component is their own id); a text of fewer words than n
is one shingle; equal texts, also repeated rows, are one node; the component
of rows without id is the least id it holds, or null. An empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .decontaminate import text_key
from .store import materialise
from .bitmap import id_bitmap, in_bitmap
from .graph import components
from .tokens import shingles_by_row, text_chunks, words

#: Shingles found in this many sets or more count as common, more if the list of common ones got too long.
COMMON = 8
MAX_COMMON = 2_000_000
#: Lists up to this length are paired out, longer ones answered through leaders.
SHORT_LIST = 16
#: A set is anchored to a leader with at least this similarity. Sets that are not meet all of a leader's sets in the
#: lists, so the outer copies of a large group of near copies are anchored too.
ANCHOR_PERCENT = 25
#: Sets with one anchor, from this number on, are kept apart by size of difference as well.
LARGE_ANCHOR = 64
#: Size bands of a block per ratio of sizes that similar sets can have. One band a ratio leaves nearly every position
#: open; eight come close to the bound of the single entries.
SIZE_BANDS = 8
_SIGN = np.uint64(1 << 63)


def _sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    for _, data, offsets in text_chunks(texts):
        h, first = words(data, offsets)
        for row in shingles_by_row(h, first, k):
            yield np.unique(row)


def _node_id(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _signed(h: np.ndarray) -> np.ndarray:
    return (h ^ _SIGN).view(np.int64)


def prefix_length(n: int, percent: int) -> int:
    """Entries of a set of ``n`` that must hold one of any set similar by ``percent``."""
    return n - -(-percent * n // 100) + 1


def _sketch(members: np.ndarray) -> bytes:
    """Members per bucket of their low bits, at most 255: the summed differences
    of two sketches never exceed the two sets' symmetric difference."""
    buckets = min(4096, max(16, 1 << max(0, (len(members) // 4).bit_length() - 1)))
    counts = np.bincount((members & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _sketch_gap(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.minimum(x.reshape(-1, len(y)).sum(axis=0, dtype=np.int64), 255)
    return int(np.abs(x.astype(np.int64) - y.astype(np.int64)).sum())


def common_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the first quarter of the hash range that many texts hold, sorted, with log2 of the number.

    They only order the prefixes (any order gives the same result), so the
    list may be bounded: it keeps the most common ones.
    """
    def quarter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s[:np.searchsorted(s, np.uint64(1 << 62))] for s in _sets(batch.column(0), k)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found)))], ["h"])
    counts = materialise(docs.select("text").mapInArrow(quarter, "h long").groupBy("h").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON), "jaccard-common")
    least = COMMON
    while counts.filter(F.col("n") >= least).count() > MAX_COMMON:
        least *= 2
    rows = counts.filter(F.col("n") >= least).toPandas()
    h = rows["h"].to_numpy(np.int64).view(np.uint64) ^ _SIGN
    order = np.argsort(h)
    return h[order], np.log2(rows["n"].to_numpy(np.float64)[order]).astype(np.int8)


def _in_order(members: np.ndarray, common: np.ndarray, weight: np.ndarray, count: int) -> tuple[np.ndarray, int]:
    """The first ``count`` of a sorted set in the global order, by quarter of the hash range, then how common, then
    hash; and how many of its first quarter are not common. Common ones are known of the first quarter only, so the
    others are in order already."""
    quarter = members[:np.searchsorted(members, np.uint64(1 << 62))]
    if not len(common) or not len(quarter):
        return members[:count], len(quarter)
    at = np.minimum(np.searchsorted(common, quarter), len(common) - 1)
    known = common[at] == quarter
    rank = np.where(known, weight[at], 0)
    first = quarter[np.argsort(rank, kind="stable")]
    rare = len(quarter) - int(np.count_nonzero(known))
    return np.concatenate([first, members[len(quarter):max(count, len(quarter))]])[:count], rare


def index_documents(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per document: doc_id, text_key, n, node, rare (see _in_order), sketch and prefix (the set's first entries in the
    global order); stored."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, k))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, weight = shared.value
        for batch in batches:
            size, node, rare, sketch, prefix = [], [], [], [], []
            for s in _sets(batch.column(1), k):
                size.append(len(s))
                node.append(_node_id(s) if len(s) else None)
                sketch.append(_sketch(s) if len(s) else None)
                first, few = _in_order(s, common, weight, prefix_length(len(s), percent) if len(s) else 0)
                rare.append(few)
                prefix.append(pa.array(_signed(first)))
            lengths = np.cumsum([0] + [len(p) for p in prefix]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(lengths), pa.concat_arrays(prefix)) if prefix else \
                pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(node, pa.binary()),
                 pa.array(rare, pa.int64()), pa.array(sketch, pa.binary()), lists],
                ["doc_id", "text_key", "n", "node", "rare", "sketch", "prefix"])
    return materialise(docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")).mapInArrow(
        index, "doc_id long, text_key binary, n long, node binary, rare long, sketch binary, prefix array<long>"),
        "jaccard-docs")


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """Least overlap of similar sets of these sizes."""
    return F.ceil(percent * (na + nb) / F.lit(100.0 + percent) - 1e-9)


def _can_meet(na: Column, pa_: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Whether sizes and positions of a shared entry leave room for the overlap, if it is the first shared one."""
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & (F.least(na - pa_, nb - pb) >= _needed(na, nb, percent)))


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()


def _unpromising_dropped(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) without those whose sketches already differ by more than similar sets can; stored."""
    side = nodes.select("nid", "n", "sketch")
    wide = (pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name).to_pylist() for name in ("na", "nb", "sa", "sb")}
            good = [_sketch_gap(sa, sb) * (100 + percent) <= (na + nb) * (100 - percent)
                    for na, nb, sa, sb in zip(c["na"], c["nb"], c["sa"], c["sb"])]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    return materialise(wide.mapInArrow(keep, "a long, b long"), "jaccard-pairs")


def _compared(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, differences: bool) -> DataFrame:
    """``pairs`` with na, nb, overlap and, if asked for, ``diff``: a's symmetric
    difference to b, entries that b lacks first."""
    nids = pairs.select(F.col("a").alias("nid")).union(pairs.select("b")).distinct()
    ids = materialise(nodes.select("nid", "node").join(nids, "nid", "left_semi"), "jaccard-wanted")
    wanted = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids, "node"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            node, members = [], []
            for s in _sets(batch.column(0), k):
                if len(s) and in_bitmap(bits, i := _node_id(s)):
                    node.append(i)
                    members.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(members, pa.binary())],
                                             ["node", "members"])
    found = docs.select("text").mapInArrow(sets, "node binary, members binary").join(ids, "node")
    stored = materialise(found.select("nid", "members").dropDuplicates(["nid"]), "jaccard-sets")
    wide = pairs.join(stored.toDF("a", "ma"), "a").join(stored.toDF("b", "mb"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, overlap, diff = [], [], [], []
            for ma, mb in zip(batch.column("ma").to_pylist(), batch.column("mb").to_pylist()):
                x, y = np.frombuffer(ma, np.uint64), np.frombuffer(mb, np.uint64)
                shared = np.intersect1d(x, y, assume_unique=True)
                na.append(len(x))
                nb.append(len(y))
                overlap.append(len(shared))
                if differences:
                    diff.append(np.concatenate([_signed(np.setdiff1d(x, shared, assume_unique=True)),
                                                _signed(np.setdiff1d(y, shared, assume_unique=True))]))
            out = [batch.column("a"), batch.column("b"), *(pa.array(v, pa.int64()) for v in (na, nb, overlap))]
            names = ["a", "b", "na", "nb", "overlap"]
            if differences:
                out.append(pa.array(diff, pa.list_(pa.int64())))
                names.append("diff")
            yield pa.RecordBatch.from_arrays(out, names)
    return wide.mapInArrow(compare, "a long, b long, na long, nb long, overlap long"
                           + (", diff array<long>" if differences else ""))


def _similar(percent: int, na: str = "na", nb: str = "nb", overlap: Column | None = None) -> Column:
    overlap = F.col("overlap") if overlap is None else overlap
    return 100 * overlap >= percent * (F.col(na) + F.col(nb) - overlap)


def links(docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Similar (a, b) pairs of node numbers, and the anchored nodes (see _same_anchor_links).

    Every similar pair is either in the first or has one anchor.
    """
    # A set without rare shingles lies in the middle of its near copies; sets with many copies come first among such.
    place = F.struct("rare", (-F.col("copies")).alias("copies"), "n", "nid")
    entries = nodes.select("nid", F.col("n").cast("int").alias("n"), "rare", "copies",
                           F.posexplode("prefix").alias("pos", "token"))
    # Most tokens have a single entry: only their counts move, then the entries of the others are kept.
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("len")).filter("len > 1")
    live = materialise(entries.join(lists, "token"), "jaccard-lists")

    # Short lists: all their pairs that can qualify. At most SHORT_LIST entries are gathered.
    short = live.filter(F.col("len") <= SHORT_LIST).groupBy("token").agg(
        F.collect_list(F.struct("nid", "n", "pos")).alias("e"))
    x = short.select("e", F.posexplode("e").alias("i", "x"))
    y = x.select("x", F.explode(F.expr("slice(e, i + 2, size(e))")).alias("y"))
    near = y.filter(_can_meet(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent)).select(
        F.col("x.nid").alias("a"), F.col("y.nid").alias("b"))
    near = _unpromising_dropped(_ordered_pairs(near), nodes, percent)
    direct = _compared(near, docs, nodes, k, differences=False).filter(_similar(percent)).select("a", "b")

    # Long lists: every entry against the leader, kept if close enough to be anchored.
    long = live.filter(F.col("len") > SHORT_LIST)
    leads = long.groupBy("token").agg(F.min(place).alias("lead"))
    led = long.join(leads, "token").filter(F.col("nid") != F.col("lead.nid")).filter(
        100 * F.least("n", "lead.n") >= ANCHOR_PERCENT * F.greatest("n", "lead.n"))
    led = _unpromising_dropped(led.select(F.col("nid").alias("a"), F.col("lead.nid").alias("b")).distinct(),
                               nodes, ANCHOR_PERCENT)
    answers = materialise(_compared(led, docs, nodes, k, differences=True)
                          .filter(_similar(ANCHOR_PERCENT)), "jaccard-answers")
    popular = answers.groupBy("b").agg(F.count(F.lit(1)).alias("members"))
    best = answers.join(popular, "b").groupBy("a").agg(F.max(F.struct("members", "b")).alias("best"))
    anchored = materialise(answers.join(best, "a").filter(F.col("b") == F.col("best.b")).select(
        F.col("a").alias("nid"), F.col("b").alias("anchor"), F.col("na").alias("n"), "diff",
        _similar(percent).alias("linked")), "jaccard-anchored")
    led_links = answers.filter(_similar(percent)).select("a", "b")

    # Long lists, pairs without a common anchor: block by block.
    rest = _ordered_pairs(_block_pairs(long, anchored, percent))
    rest = _unpromising_dropped(rest.join(answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")),
                                          ["a", "b"], "left_anti"), nodes, percent)
    others = direct.unionByName(led_links)
    if not rest.isEmpty():
        others = others.unionByName(
            _compared(rest, docs, nodes, k, differences=False).filter(_similar(percent)).select("a", "b"))
    return others, anchored


def _most_apart(n: Column, percent: int) -> Column:
    """Most entries by which similar sets of ``n`` entries together differ."""
    return F.floor(n * (100 - percent) / F.lit(100.0 + percent) + 1e-9)


def _same_anchor_links(anchored: DataFrame, percent: int, linked_ones: bool) -> DataFrame:
    """Similar pairs (a, b) with one anchor that are not sure (see _sure), from the differences alone; pairs of which
    both are linked to the anchor only if ``linked_ones``.

    |x ^ y| = |Dx ^ Dy| for differences to the same anchor, so the pair needs s = (|Dx| + |Dy| - H) / 2 shared
    entries, H being the most that similar sets of these sizes differ by: a prefix join again, keyed by anchor and
    entry, in which x brings its first |Dx| - s + 1 entries, those that the anchor lacks first. A set that is not
    linked to the anchor is sure of none, so s is never below one.

    One prefix for partners of all sizes would have to hold nearly all of a difference, also the entries lost from
    the anchor, which the sets of a large anchor share by the hundred. There differences are cut into bands by size,
    and a set brings a prefix of its own to each band it can have partners in; sets of like size need but the first
    half of their differences.
    """
    rows = anchored.select("nid", "anchor", "n", "linked", F.size("diff").cast("long").alias("d"), "diff")
    groups = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("members"), F.max("n").alias("top"))
    quarter = F.greatest(F.floor(_most_apart(2 * F.col("top"), percent) / 4), F.lit(1))
    rows = rows.join(groups.filter("members > 1").select("anchor", "top", F.when(
        F.col("members") >= LARGE_ANCHOR, quarter).otherwise(F.lit(1 << 40)).alias("width")), "anchor")
    most = _most_apart(F.col("n") + F.least("top", F.floor(F.col("n") * 100 / F.lit(percent))), percent)
    rows = rows.withColumn("most", most).withColumn("least", F.greatest(F.col("d") - F.col("most"), F.lit(0)))
    rows = rows.withColumn("own", F.floor(F.col("d") / F.col("width"))).withColumn("other", F.explode(F.sequence(
        F.floor(F.col("least") / F.col("width")), F.floor((F.col("d") + F.col("most")) / F.col("width")))))
    partner = F.greatest(F.col("other") * F.col("width"), F.col("least"))
    share = F.greatest(F.ceil((F.col("d") + partner - F.col("most")) / 2), F.lit(1))
    keys = rows.select("nid", "anchor", "n", "linked", "d", "own", "other", F.posexplode(F.slice(
        "diff", F.lit(1), F.greatest(F.col("d") - share + 1, F.lit(0)).cast("int"))).alias("pos", "key"))
    x, y = (keys if linked_ones else keys.filter(~F.col("linked"))).alias("x"), keys.alias("y")
    once = F.col("x.nid") < F.col("y.nid")
    both = F.col("x.d") + F.col("y.d") - _most_apart(F.col("x.n") + F.col("y.n"), percent)
    pairs = x.join(y, (F.col("x.anchor") == F.col("y.anchor")) & (F.col("x.key") == F.col("y.key"))
                   & (F.col("x.own") == F.col("y.other")) & (F.col("x.other") == F.col("y.own"))
                   & (once if linked_ones else once | F.col("y.linked"))
                   & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
                   & (F.abs(F.col("x.d") - F.col("y.d")) <= _most_apart(F.col("x.n") + F.col("y.n"), percent))
                   & (both > 0) & (2 * F.least(F.col("x.d") - F.col("x.pos"), F.col("y.d") - F.col("y.pos")) >= both))
    pairs = pairs.select(F.col("x.nid").alias("a"), F.col("y.nid").alias("b")).distinct()
    side = anchored.select("nid", "n", "diff")
    wide = pairs.join(side.toDF("a", "na", "da"), "a").join(side.toDF("b", "nb", "db"), "b")
    apart = F.size("da") + F.size("db") - 2 * F.size(F.array_intersect("da", "db"))
    return wide.filter(_similar(percent, overlap=(F.col("na") + F.col("nb") - apart) / 2)).select("a", "b")


def _sure(percent: int, x: str, y: str) -> Column:
    """Whether two sets with one anchor are similar even if their differences to it (of sizes d) share nothing."""
    n = F.col(f"{x}.n") + F.col(f"{y}.n")
    return _similar(percent, f"{x}.n", f"{y}.n", (n - F.col(f"{x}.d") - F.col(f"{y}.d")) / 2)


def link_counts(pairs: DataFrame, same: DataFrame, anchored: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(nid, others): for each node with links, the rows of all other nodes similar to it.

    ``pairs`` and ``anchored`` are those of links(), ``same`` all pairs of _same_anchor_links; ``nodes`` has nid and
    copies. Sure pairs with one anchor are counted per size of set and difference.
    """
    copies = nodes.select("nid", "copies")
    own = anchored.select("nid", "anchor")
    apart = (_ordered_pairs(pairs).join(own.toDF("a", "anchor_a"), "a", "left").join(own.toDF("b", "anchor_b"), "b", "left")
             .filter("anchor_a is null or anchor_b is null or anchor_a != anchor_b").select("a", "b"))
    sized = materialise(anchored.join(copies, "nid").select(
        "nid", "anchor", "n", F.size("diff").cast("long").alias("d"), "copies"), "jaccard-sized")
    kinds = materialise(sized.groupBy("anchor", "n", "d").agg(F.sum("copies").alias("rows")), "jaccard-kinds")
    x, y = kinds.alias("x"), kinds.alias("y")
    near = x.join(y, F.col("x.anchor") == F.col("y.anchor")).filter(_sure(percent, "x", "y")).groupBy(
        F.col("x.anchor").alias("anchor"), F.col("x.n").alias("n"), F.col("x.d").alias("d")).agg(
        F.sum("y.rows").alias("rows"))
    # A set may be sure of itself: it is in its own kind.
    itself = _similar(percent, "n", "n", F.col("n") - F.col("d"))
    sure = sized.join(near, ["anchor", "n", "d"]).select(
        "nid", (F.col("rows") - F.when(itself, F.col("copies")).otherwise(0)).alias("others"))

    both = materialise(apart.unionByName(same), "jaccard-links")
    ends = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = ends.join(copies.toDF("b", "copies"), "b").select(F.col("a").alias("nid"), F.col("copies").alias("others"))
    return met.unionByName(sure).groupBy("nid").agg(F.sum("others").alias("others"))


#: Entries of one list, owner, size band and position band.
_BLOCK = ["token", "owner", "band", "cut"]


def _opened_blocks(entry: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks (x_ and y_ of _BLOCK, in one list, of two owners) of which a summary (sizes, least position)
    says that entries can meet."""
    blocks = entry.groupBy(*_BLOCK).agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("p0"))
    p, q = blocks.alias("p"), blocks.alias("q")
    room = F.least(F.col("p.n1") - F.col("p.p0"), F.col("q.n1") - F.col("q.p0"))
    opened = p.join(q, (F.col("p.token") == F.col("q.token")) & (F.col("p.owner") < F.col("q.owner"))
                    & (F.abs(F.col("p.band") - F.col("q.band")) <= SIZE_BANDS)
                    & (100 * F.col("p.n1") >= percent * F.col("q.n0"))
                    & (100 * F.col("q.n1") >= percent * F.col("p.n0"))
                    & (room >= _needed(F.col("p.n0"), F.col("q.n0"), percent)))
    return opened.select(*[F.col(f"p.{c}").alias(f"x_{c}") for c in _BLOCK],
                         *[F.col(f"q.{c}").alias(f"y_{c}") for c in _BLOCK[1:]])


def _block_pairs(long: DataFrame, anchored: DataFrame, percent: int) -> DataFrame:
    """Pairs within long lists that have no common anchor and can still qualify.

    A list is cut into blocks by size band and position, see _opened_blocks.
    """
    owner = anchored.select("nid", "anchor").unionByName(
        anchored.select(F.col("anchor").alias("nid"), "anchor")).groupBy("nid").agg(F.max("anchor").alias("anchor"))
    entry = long.join(owner, "nid", "left").select(
        "token", "nid", "n", "pos", F.coalesce("anchor", "nid").alias("owner"),
        F.floor(SIZE_BANDS * F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).alias("band"),
        F.floor(F.col("pos") * 64 / F.col("n")).alias("cut"))
    # Entries of one owner need no pairs among themselves; lists of a single owner end here.
    owners = entry.groupBy("token").agg(F.min("owner").alias("o1"), F.max("owner").alias("o2")).filter("o1 != o2")
    entry = entry.join(owners.select("token"), "token", "left_semi")
    opened = _opened_blocks(entry, percent)
    left = entry.select(*[F.col(c).alias(f"x_{c}") for c in _BLOCK], F.col("nid").alias("a"),
                        F.col("n").alias("na"), F.col("pos").alias("pa"))
    right = entry.select(F.col("token").alias("x_token"), *[F.col(c).alias(f"y_{c}") for c in _BLOCK[1:]],
                         F.col("nid").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    met = opened.join(left, [f"x_{c}" for c in _BLOCK]).join(right, ["x_token"] + [f"y_{c}" for c in _BLOCK[1:]])
    return met.filter(_can_meet(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), percent)).select("a", "b")


def similar_components(docs: DataFrame, k: int, percent: int, count_links: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_key (see decontaminate), n (set size), node and root (a
    component's own number; both null for an empty set), component_id (least doc_id reachable over pairs similar by ``percent``) and, if asked for, n_links (the number of
    other rows similar to it, rows of the same set included; 0 for an empty set)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    indexed = index_documents(docs, k, percent)
    nodes = materialise(indexed.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.first("rare").alias("rare"), F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix"))
        .withColumn("nid", F.monotonically_increasing_id()), "jaccard-nodes")
    pairs, anchored = links(docs, nodes, k, percent)
    same = _same_anchor_links(anchored, percent, linked_ones=count_links)
    if count_links:
        pairs, same = materialise(pairs, "jaccard-similar"), materialise(same, "jaccard-same-anchor")
    roots = components(pairs.unionByName(same)).withColumnRenamed("node", "nid")
    labelled = nodes.select("node", "nid", "least", "copies").join(roots, "nid", "left").withColumn(
        "root", F.coalesce("root", "nid"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = labelled.join(least, "root")
    counted = []
    if count_links:
        by_node = by_node.join(link_counts(pairs, same, anchored, nodes, percent), "nid", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
        counted = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")]
    by_node = by_node.select("node", "root", "component_id", *(["n_links"] if count_links else []))
    return indexed.select("doc_id", "text_key", "n", "node").join(by_node, "node", "left").select(
        "doc_id", "text_key", "n", "node", "root", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"), *counted)
