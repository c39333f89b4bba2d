"""Property tests: Spark operators against plain-Python references on generated data."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from appmart import functions as fn
from appmart import operators as ops
from appmart.functions.keys import campaign_key

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# Letters, digits, punctuation and every kind of blank the rules treat
# differently: ASCII blanks (squeezed), vertical tab (only trimmed), and
# Unicode spaces (only trimmed).
ALPHABET = "aAbBzZ09.-_ \t\n\r\f\x0b\u3000\u2003\u00a0"
texts = st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12))

# Unicode White_Space code points (the trim set).
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680,
                                *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def py_normalize(s: str | None) -> str:
    s = (s or "").lower()
    s = re.sub(r"[\t\n\f\r ]+", " ", s)
    return s.strip(WHITE_SPACE)


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=20))
def test_normalize_text_matches_reference(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(fn.normalize_text("x")).collect()]
    assert got == [py_normalize(v) for v in values]


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=20))
def test_normalize_text_is_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    once = df.select(fn.normalize_text("x").alias("y"))
    twice = once.select(fn.normalize_text("y").alias("z"))
    assert [r[0] for r in once.collect()] == [r[0] for r in twice.collect()]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["2024-01-05", "2024-1-5", None]), texts, texts),
                min_size=1, max_size=15))
def test_campaign_key_matches_reference(spark, rows):
    df = spark.createDataFrame(rows, "d string, c string, n string")
    day = fn.format_day(fn.parse_date("d"))
    got = [r[0] for r in df.select(campaign_key(day, "c", "n")).collect()]
    want = [hashlib.md5(((("2024-01-05") if d else "") + py_normalize(c) + py_normalize(n))
                        .encode("utf-8")).hexdigest() for d, c, n in rows]
    assert got == want


small_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                                st.one_of(st.none(), st.sampled_from(["a", "b", ""]))),
                      max_size=30)


@SETTINGS
@given(small_rows)
def test_row_stats_matches_counter(spark, rows):
    df = spark.createDataFrame(rows, "i int, s string")
    r = ops.row_stats(df).first()
    assert (r["row_count"], r["distinct_row_count"]) == (len(rows), len(Counter(rows)))


@SETTINGS
@given(small_rows, small_rows, small_rows)
def test_union_distinct_matches_set_union(spark, a, b, c):
    frames = [spark.createDataFrame(x, "i int, s string") for x in (a, b, c)]
    got = {tuple(r) for r in ops.union_distinct(*frames).collect()}
    assert got == set(a) | set(b) | set(c)
    assert ops.union_distinct(*frames).count() == len(set(a) | set(b) | set(c))
