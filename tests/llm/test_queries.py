"""Whole queries on tables with odd rows, against their contracts computed row by row."""

from __future__ import annotations

import time
import zlib
from collections import Counter

import pytest

from appmart.llm import dom, html_extract, queries

DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot string"
PAGE = "page_id long, url string, html string, text string, d string"


def _write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd_documents(spark, tmp_path_factory):
    rows = [(i, f"text {i} ü", None, None, None, "a", "b") for i in range(200)]
    rows += [(1000, None, None, None, None, None, None), (1001, "", None, None, None, None, None),
             (None, "no id", None, None, None, None, None), (1002, "long " * 100_000, None, None, None, None, None)]
    rows += [(1003, "same", None, None, None, None, None)] * 50  # repeated rows
    return rows, _write(spark, tmp_path_factory.mktemp("docs"), "documents", rows, DOC)


def test_sharding_query_holds_its_contract(spark, odd_documents):
    rows, folder = odd_documents
    got = [tuple(r) for r in queries.op2_sharding(spark, folder).collect()]
    data = lambda t: (t or "").encode()
    want = Counter((i, len(data(t)) + 8, None if t is None else zlib.crc32(data(t)), "rows", None) for i, t, *_ in rows)
    assert Counter((i, size, crc, law, grown) for i, size, crc, law, _, _, grown in got) == want
    shards = Counter(r[4] for r in got)
    assert set(shards) <= set(range(24)) and max(shards.values()) - min(shards[s] for s in range(24)) <= 1
    for s in shards:
        assert sorted(r[5] for r in got if r[4] == s) == list(range(shards[s]))
    again = [tuple(r) for r in queries.op2_sharding(spark, folder).collect()]
    assert Counter(again) == Counter(got)


def test_sharding_of_an_empty_table(spark, tmp_path):
    assert queries.op2_sharding(spark, _write(spark, tmp_path, "documents", [], DOC)).collect() == []


ARTICLE = "<p>" + "A long paragraph of the story that goes on for quite some words. " * 6 + "</p>"
HTML = f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article class='post-body'>{ARTICLE * 3}</article></body></html>"


@pytest.fixture(scope="module")
def odd_pages(spark, tmp_path_factory):
    rows = [(1, "http://a/", None, None, None), (2, None, "", "x", "y"), (3, "u", HTML, None, None),
            (3, "u", HTML, None, None), (None, "u", HTML, None, None),
            (4, "u", "<div>" * 20_000 + ARTICLE, None, None), (5, "u", "plain text &amp; no markup", None, None),
            (6, "u", HTML.replace("story", "story " * 20_000), None, None)]
    return rows, _write(spark, tmp_path_factory.mktemp("pages"), "pages", rows, PAGE)


def test_extraction_query_on_odd_pages(spark, odd_pages):
    rows, folder = odd_pages
    got = queries.op5_html_extract(spark, folder)
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    found = [tuple(r)[:4] for r in got.collect()]
    assert Counter((p, u) for p, u, _, _ in found) == Counter((p, u) for p, u, *_ in rows)
    assert all(t is not None and n == len(t) for _, _, t, n in found)
    by = {p: t for p, _, t, _ in found}
    assert by[1] == by[2] == ""
    paragraph = " ".join(ARTICLE[3:-4].split())
    assert by[3] == by[None] == "\n".join([paragraph] * 3) and "Home" not in by[3]
    assert len(by[6]) > 3 * 6 * 20_000 * 6


def test_extraction_of_an_empty_table(spark, tmp_path):
    assert queries.op5_html_extract(spark, _write(spark, tmp_path, "pages", [], PAGE)).collect() == []


def test_elements_nested_deeply_take_linear_time():
    began = time.process_time()
    page = dom.Page("<div>" * 100_000 + "text" + "</b>" * 1000)
    html_extract.features(page)
    assert max(page.depth) == 100_000 and time.process_time() - began < 30


def test_open_elements_are_known_after_every_kind_of_end():
    page = dom.Page("<p>a<b>b<div>c</b>d</div>e<li>f<li>g<table><tr><td>h<td>i</table><p>j<p>k")
    parents = [page.tag[page.parent[e]] for e, _, _ in page.runs]
    assert [t for _, _, t in page.runs] == list("abcdefghijk")
    assert [page.tag[e] for e, _, _ in page.runs] == ["p", "b", "div", "div", "#page", "li", "li", "td", "td", "p", "p"]
    assert len(parents) == 11
