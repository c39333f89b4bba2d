"""Periodic runs of words (operator 11), by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), of at least ``max(min_words, min_exponent * q)`` words, that no
neighbouring word extends keeping period q.

* **Candidates on harmonic grids.** A run of period p and ``min_exponent * p``
  words holds that many consecutive multiples of p, and the words there are
  identical. So for each p only the multiples of p are looked at (n ln n places
  in all), and a place is a candidate if the words at it and at the next
  ``min_exponent - 1`` multiples are the same word.
* **Recompression.** The texts that have candidates are compressed bottom-up:
  block compression (a repeated symbol a^k becomes one symbol) alternates with
  pair compression (the alphabet is split in two halves and each pair of a left
  and a right symbol becomes one symbol). The levels are a run-length grammar in
  which equal stretches get equal symbols but for O(1) symbols at their borders.
* **Grammar LCE.** The longest common extension of two places climbs the levels
  as long as the symbols agree and comes down again at the first difference. The
  same walk on mirrored levels extends to the left. A candidate (i, p) gives the
  run that begins ``back(i - 1, i + p - 1)`` words before i and ends
  ``ahead(i, i + p)`` words after i + p: the exact maximal stretch of period p.
* A stretch found under several periods is the run of the smallest one: two
  periods of a stretch this long have their common divisor as a period
  (Fine and Wilf), and that divisor finds the same maximal stretch.

All steps are numpy over a chunk of texts; words are numbered exactly, by the
bytes, so nothing rests on hashes. No shuffle: each text is its own task's work.

Cases: a null text is the empty one, without runs. A null id keeps its text as
it is. Words are compared byte by byte (case matters). A text of n equal words
takes O(n log n) steps. Repeated rows give repeated rows; columns other than
those kept play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MIN_WORDS, MIN_EXPONENT = 6, 4
#: Bytes of texts that are worked on together; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 19
#: Grid places that are looked at together.
PLACES = 1 << 19
#: Runs of so many words spare the candidates inside them.
LONG_RUN = 64
_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

Edit = Callable[[list[bytes], "int | None"], list[bytes]]


def _coin(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A fixed pseudo-random bit of every symbol, other ones each turn."""
    x = symbols.astype(_U) * _M1 + _U((turn + 1) * int(_M2) & (1 << 64) - 1)
    x ^= x >> _U(31)
    x *= _M1
    return (x >> _U(63)).astype(bool)


class Level:
    """One string of the grammar and how its symbols group into those of the next level.

    ``up`` gives the group of each symbol, ``start`` the first symbol of each group (and the
    length at the end), ``block`` says whether the groups are blocks of one symbol or pairs.
    """

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.up = self.start = None
        self.block = False

    def group(self, first: np.ndarray, block: bool) -> None:
        """``first`` marks the symbols that begin a group."""
        self.up = np.cumsum(first) - 1
        self.start = np.append(np.flatnonzero(first), len(first))
        self.block = block

    def mirrored(self) -> "Level":
        out = Level(self.symbols[::-1])
        if self.up is not None:
            n, groups = len(self.symbols), len(self.start) - 1
            out.up = groups - 1 - self.up[::-1]
            out.start = n - self.start[::-1]
            out.block = self.block
        return out


def recompress(symbols: np.ndarray, fixed: int) -> list[Level]:
    """The levels of ``symbols``. Those below ``fixed`` occur once each and are never grouped."""
    levels, fresh, turn = [Level(symbols)], int(symbols.max(initial=0)) + 1, 0
    while True:
        now = levels[-1]
        s = now.symbols
        free = s >= fixed
        if not (free[:-1] & free[1:]).any():
            return levels
        first = np.append(True, s[1:] != s[:-1])
        if not first.all():  # block compression
            now.group(first, True)
            size = np.diff(now.start)
            heads = s[now.start[:-1]].copy()
            many = np.flatnonzero(size > 1)
            kinds, which = np.unique(heads[many] * (len(s) + 1) + size[many], return_inverse=True)
            heads[many] = fresh + which
            fresh += len(kinds)
            levels.append(Level(heads))
            continue
        side = _coin(s, turn)
        turn += 1
        ahead, behind = (np.flatnonzero((free & x)[:-1] & (free & ~x)[1:]) for x in (side, ~side))
        at = ahead if len(ahead) >= len(behind) else behind
        if not len(at):
            continue
        first = np.ones(len(s), dtype=bool)
        first[at + 1] = False
        now.group(first, False)
        kinds, which = np.unique(s[at] * fresh + s[at + 1], return_inverse=True)
        joined = s.copy()
        joined[at] = fresh + which
        fresh += len(kinds)
        levels.append(Level(joined[first]))


def extensions(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Longest common extension of the places x and y (x != y) of the lowest level, for all pairs at once."""
    a, b = x.copy(), y.copy()
    differ = np.zeros(len(x), dtype=np.int64)  # the level at which the symbols at a and b are known to differ
    live = np.arange(len(x))
    top = len(levels) - 1
    for k, level in enumerate(levels):
        if not len(live):
            break
        s = level.symbols
        if k == top:
            while len(live):
                live = live[s[a[live]] == s[b[live]]]
                a[live] += 1
                b[live] += 1
            differ[differ == 0] = top  # those that were live here; the rest is corrected below
            break
        p, q = a[live], b[live]
        inside = np.flatnonzero((level.start[level.up[p]] != p) | (level.start[level.up[q]] != q))
        stop = np.zeros(len(live), dtype=bool)
        if len(inside):
            pi, qi = p[inside], q[inside]
            same = s[pi] == s[qi]
            if level.block:
                left, right = level.start[level.up[pi] + 1] - pi, level.start[level.up[qi] + 1] - qi
                step = np.where(same, np.minimum(left, right), 0)
                stop[inside] = ~same | (left != right)
            else:
                step = same.astype(np.int64)
                stop[inside] = ~same
            p[inside] += step
            q[inside] += step
        gone = live[stop]
        a[gone], b[gone] = p[stop], q[stop]
        differ[gone] = k if k else -1
        live = live[~stop]
        a[live], b[live] = level.up[p[~stop]], level.up[q[~stop]]
    differ[differ == -1] = 0
    for k in range(top, 0, -1):
        level = levels[k - 1]
        down = np.flatnonzero(differ >= k)
        if not len(down):
            continue
        p, q = level.start[a[down]], level.start[b[down]]
        same = np.flatnonzero(level.symbols[p] == level.symbols[q])
        if level.block:
            ps, qs = p[same], q[same]
            step = np.minimum(level.start[level.up[ps] + 1] - ps, level.start[level.up[qs] + 1] - qs)
        else:
            step = 1
        p[same] += step
        q[same] += step
        a[down], b[down] = p, q
    return a - x


def _grid(first: np.ndarray, n: np.ndarray, exponent: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the grid places of all texts, periods ascending.

    At most about PLACES at a time, or those of one period, and no period twice the first: so runs
    found at small periods spare places at large ones.
    """
    texts = np.flatnonzero(n >= max(least, exponent))
    most = n[texts] // exponent
    order = np.argsort(most, kind="stable")
    texts, most = texts[order], most[order]
    done, highest = 0, int(most[-1]) if len(most) else 0
    while done < highest:
        # As many periods at once as fit, one at least.
        active = texts[np.searchsorted(most, done + 1):]
        upto, places = done, 0
        while upto < min(highest, 2 * done + 1):
            rows = texts[np.searchsorted(most, upto + 1):]
            more = int(((n[rows] - 1) // (upto + 1)).sum())
            if places and places + more > PLACES:
                break
            places += more
            upto += 1
            if len(rows) * (upto - done) > PLACES:
                break
        periods = np.arange(done + 1, upto + 1)
        doc = np.tile(active, len(periods))
        p = np.repeat(periods, len(active))
        fits = n[doc] >= exponent * p
        doc, p = doc[fits], p[fits]
        count = (n[doc] - 1) // p - (exponent - 2)
        total = np.cumsum(count)
        j = np.arange(int(total[-1])) - np.repeat(total - count, count)
        pair = np.repeat(np.arange(len(doc)), count)
        period = p[pair]
        yield doc[pair], first[doc[pair]] + j * period, period
        done = upto


def _alike(w: np.ndarray, place: np.ndarray, period: np.ndarray, exponent: int) -> np.ndarray:
    """Indices of the places whose word is that of the next ``exponent - 1`` multiples of the period."""
    kept = np.flatnonzero(w[place] == w[place + period])
    for m in range(2, exponent):
        kept = kept[w[place[kept]] == w[place[kept] + m * period[kept]]]
    return kept


def find_runs(words: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS,
              min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` are the word numbers of all texts, ``first`` where each text's begin (one more at
    the end); starts count from the text's own first word.
    """
    if min_exponent < 2:
        raise ValueError("a run needs two periods at least")
    n = np.diff(first)
    some = np.zeros(len(n), dtype=bool)
    for doc, place, period in _grid(first[:-1], n, min_exponent, min_words):
        some[doc[_alike(words, place, period, min_exponent)]] = True
    docs = np.flatnonzero(some)
    if not len(docs):
        return (np.empty(0, np.int64),) * 4
    # The texts with candidates, each between separators of its own (numbers below ``fixed``).
    fixed, size = len(docs) + 1, n[docs]
    begin = np.cumsum(size + 1) - size
    w = np.empty(int(size.sum()) + fixed, dtype=np.int64)
    w[0], w[begin + size] = 0, np.arange(1, fixed)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    w[np.repeat(begin, size) + inner] = words[np.repeat(first[docs], size) + inner] + fixed
    levels = recompress(w, fixed)
    back = [level.mirrored() for level in levels]
    last = len(w) - 1
    over, through = np.zeros(len(w), dtype=np.int64), np.ones(len(w), dtype=np.int64)
    found = []
    for doc, place, period in _grid(begin, size, min_exponent, min_words):
        # Inside a known run whose period divides this one lies that run again.
        new = np.flatnonzero((over[place] <= place + (min_exponent - 1) * period) | (period % through[place] != 0))
        new = new[_alike(w, place[new], period[new], min_exponent)]
        if not len(new):
            continue
        doc, i, p = doc[new], place[new], period[new]
        end = i + p + extensions(levels, i, i + p)
        start = i - extensions(back, last - (i - 1), last - (i + p - 1))
        good = end - start >= np.maximum(min_words, min_exponent * p)
        if not good.any():
            continue
        rows = np.unique(np.stack([doc[good], start[good], end[good], p[good]]), axis=1)
        found.append(rows)
        for _, s, e, q in rows[:, rows[2] - rows[1] >= LONG_RUN].T.tolist():
            # The longer run of a place is remembered.
            part = over[s:e]
            longer = part < e
            part[longer] = e
            through[s:e][longer] = q
    if not found:
        return (np.empty(0, np.int64),) * 4
    doc, start, end, p = np.concatenate(found, axis=1)
    order = np.lexsort((p, end, start, doc))
    doc, start, end, p = doc[order], start[order], end[order], p[order]
    once = np.append(True, (np.diff(doc) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0))
    doc, start, end, p = doc[once], start[once], end[once], p[once]
    order = np.lexsort((p, start, doc))
    doc, start, end, p = doc[order], start[order], end[order], p[order]
    return docs[doc], start - begin[doc], end - start, p


def dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _chunks(rows: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows of about CHUNK_BYTES."""
    texts, size, first = [], 0, 0
    for k, text in enumerate(rows.column(1).cast(pa.large_binary())):
        texts.append(text.as_py() or b"")
        size += len(texts[-1])
        if size >= CHUNK_BYTES:
            yield first, texts
            texts, size, first = [], 0, k + 1
    if texts:
        yield first, texts


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, keep: list[str], text: str | Column = "text", key: str | Column | None = None,
                  edit: Edit | None = None, min_words: int = MIN_WORDS,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Runs of every text: struct ``d`` of the columns ``keep``, ``n_words``, ``runs``
    (start, length, period by start and period) and ``collapsed`` (the words that no run repeats,
    joined by one space).

    ``edit`` changes the words of a text before the search; it gets them and the row's ``key``.
    """
    source = docs.select(F.struct(*keep).alias("d"),
                         (F.col(text) if isinstance(text, str) else text).cast("string").alias("text"),
                         (F.lit(None) if key is None else F.col(key) if isinstance(key, str) else key)
                         .cast("long").alias("key"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at, texts in _chunks(rows):
                number: dict[bytes, int] = {}
                keys = rows.column(2).slice(at, len(texts)).to_pylist() if edit else [None] * len(texts)
                split, numbers, first = [], [], [0]
                for raw, own in zip(texts, keys):
                    words = raw.split()  # bytes split at space and \t to \r only
                    if edit:
                        words = edit(words, own)
                    split.append(words)
                    numbers += [number.setdefault(x, len(number)) for x in words]
                    first.append(len(numbers))
                first = np.array(first, dtype=np.int64)
                doc, start, length, period = find_runs(np.array(numbers, dtype=np.int64), first,
                                                       min_words, min_exponent)
                edge = np.searchsorted(doc, np.arange(len(texts) + 1))
                shorter = []
                for k, words in enumerate(split):
                    a, b = edge[k], edge[k + 1]
                    if b > a:
                        gone = dropped(len(words), start[a:b], length[a:b], period[a:b]).tolist()
                        words = [x for x, g in zip(words, gone) if not g]
                    shorter.append(b" ".join(words))
                runs = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(length), pa.array(period)], fields=list(_RUN.value_type)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(at, len(texts)), pa.array(np.diff(first)), runs,
                     pa.array(shorter, pa.large_binary()).cast(pa.large_string())],
                    names=["d", "n_words", "runs", "collapsed"])

    kind = source.schema["d"].dataType.simpleString()
    return source.mapInArrow(search, f"d {kind}, n_words long, "
                             "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """``d``, n_runs, the run of the greatest exponent (ties: smallest start, then period), and SHA-256 of runs and words left."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # length/period as a double is exact enough to order runs of under 10^8 words and equal for equal fractions.
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
                    lambda top, r: F.when(r["length"] / r["period"] > top["length"] / top["period"], r).otherwise(top))
    return found.select("d", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), "runs", "collapsed",
                        F.array_join(line, "").alias("lines")).select(
        "d", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").cast("long").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
