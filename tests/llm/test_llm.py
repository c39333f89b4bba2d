"""The training-data operators against brute force, round trips and held-out accuracy, on small fixtures."""

from __future__ import annotations

import math
import random
import time
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from appmart.llm import (decontaminate, html_extract, lm_score, mixing, ngram_jaccard, quality_rules, queries, sharding,
                         store, substring_dedup, tokens, url_filter, warc)

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def _words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows and ids, a long text, clashing extra columns."""
    rng = random.Random(5)
    base = [rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(160)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (None, " ".join(base)), (6, " ".join(base)),
            (6, " ".join(base)), (7, " ".join(base).upper()), (8, "x " * 5000)]
    for i in range(60):  # near copies at different distances
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = "z" + str(rng.randint(0, 9))
        rows.append((100 + i, " ".join(copy)))
    rows += [(300 + i, " ".join(rng.choice("pqrstuvw") + str(rng.randint(0, 99)) for _ in range(120))) for i in range(10)]
    data = [(i, t, None if (i or 0) % 7 == 0 else "en", None if (i or 0) % 5 == 0 else "s", None) for i, t in rows]
    docs = spark.createDataFrame(data, DOC)
    return docs.withColumn("n_words", F.lit("x")).withColumn("node", F.lit(1)).withColumn("tokens", F.lit(0))


def _components(rows, k, percent):
    sets = [(i, frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if (w := _words(t)) else frozenset())
            for i, t in rows]
    kinds = list({s for _, s in sets if s})
    root = list(range(len(kinds)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(kinds)):
        for b in range(a):
            same = len(kinds[a] & kinds[b])
            if 100 * same >= percent * (len(kinds[a]) + len(kinds[b]) - same):
                root[find(a)] = find(b)
    least = {}
    for i, s in sets:
        if s and i is not None:
            r = find(kinds.index(s))
            least[r] = min(least.get(r, i), i)
    return Counter((i, len(s), least.get(find(kinds.index(s))) if s else i) for i, s in sets)


def test_words_are_the_split_of_lowered_bytes():
    texts = ["a B\tc\x0bd\n", None, "", "  Ünï Code  " + "long" * 30, "x\x1cy"]
    got = [tokens.words(d, o) for _, d, o in tokens.text_chunks(pa.array(texts))]
    hashes, first = got[0]
    want = [_words(t) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat)) and len(hashes) == len(flat)


@pytest.mark.parametrize("short, large", [(16, 64), (1, 1 << 40), (1, 2)])
def test_jaccard_components_equal_brute_force(spark, odd_docs, monkeypatch, short, large):
    monkeypatch.setattr(ngram_jaccard, "LARGE_ANCHOR", large)  # 2: every anchor's differences are cut into bands
    monkeypatch.setattr(ngram_jaccard, "SHORT_LIST", short)  # 1: every list goes through leaders and anchors
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = ngram_jaccard.similar_components(odd_docs, 3, 90).collect()
    assert Counter((r["doc_id"], r["n"], r["component_id"]) for r in got) == _components(rows, 3, 90)


@pytest.mark.parametrize("short, large", [(16, 64), (1, 1 << 40), (1, 2)])
def test_jaccard_links_equal_brute_force(spark, odd_docs, monkeypatch, short, large):
    monkeypatch.setattr(ngram_jaccard, "LARGE_ANCHOR", large)  # 2: every anchor's differences are cut into bands
    monkeypatch.setattr(ngram_jaccard, "SHORT_LIST", short)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    sets = [frozenset(tuple(w[j:j + 3]) for j in range(max(1, len(w) - 2))) if (w := _words(t)) else None for _, t in rows]
    want = Counter()
    for at, (x, (i, _)) in enumerate(zip(sets, rows)):
        want[i, sum(10 * len(x & y) >= 9 * len(x | y) for k, y in enumerate(sets) if k != at and y) if x else 0] += 1
    got = ngram_jaccard.similar_components(odd_docs, 3, 90, count_links=True).collect()
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == want and max(n for _, n in want) > 20


def test_near_duplicates_go_by_row_not_by_id(spark):
    rng = random.Random(9)
    a, c, d = (_four_letters(rng, 60) for _ in range(3))
    near = lambda w: " ".join(w[:-1] + ["edit"])
    rows = [(1, " ".join(a)), (5, near(a)), (5, " ".join(c)), (9, near(d)), (5, " ".join(d)), (5, " ".join(d)),
            (7, ""), (7, None), (None, " ".join(a))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(
        [rows[0], rows[2], rows[4], rows[6], rows[7], rows[8]])


def test_sharding_law_and_determinism(spark, odd_docs):
    got = sharding.shard_rows(odd_docs, 7).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == odd_docs.count() and max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted((r["shard"], r["slot"]) for r in got) == sorted((s, k) for s, n in sizes.items() for k in range(n))
    matrix = sharding.communication_matrix([5, 0, 11, 3], 4, 1)
    assert [sum(m) for m in matrix] == [5, 0, 11, 3] and sorted(map(sum, zip(*matrix))) == [4, 5, 5, 5]
    draws = [sharding._hypergeometric(np.random.default_rng(s), 10**10, 10**10, 10**6) for s in range(20)]
    assert all(abs(d - 500_000) < 5000 for d in draws) and len(set(draws)) > 10


def test_url_rules_and_held_out_accuracy(spark):
    model = url_filter.train(url_filter.labelled_urls(spark))
    urls = ["http://a.org/x", "http://Example.ORG/es/1", "https://w.example.org/en/17?q", "http://org", "http://borg/x",
            "http://x.com/fr/", "http://x.com/de/5", None, "", "no-url", "http://casino-spam.example.net/1",
            "http://free-poker-slots.example.net/en/3", "http://quiet-garden.example.net/1", "http://stonebridge.example.net/"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("host", F.lit("x"))
    got = {r["d"]["page_id"]: (r["rule"], r["verdict"]) for r in
           url_filter.judge(rows, "url", ["page_id", "host"], queries.URL_RULES, model).collect()}
    assert [got[i][0] for i in range(7)] == ["org/", "example.org/es/", "example.org/en/1", None, None, "com/fr/", "com/de/"]
    assert [got[i][1] for i in (0, 1, 2, 5, 6)] == ["allow", "block", "block", "allow", "block"]
    assert [got[i][1] for i in range(7, 14)] == ["allow"] * 3 + ["block"] * 2 + ["allow"] * 2


def _against_sql(spark, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    rows = want.fetchall()
    got = queries.queries()[name](spark, SF).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(rows)


def test_quality_rules_equal_sql(spark):
    _against_sql(spark, "op4_quality_rules", ["documents"])


def test_quality_rules_on_odd_rows(spark, odd_docs):
    got = {r["d"]["doc_id"]: r for r in quality_rules.judge(odd_docs, ["doc_id"]).collect()}
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and not got[1]["kept"]
    assert got[8]["n_words"] == 5000 == got[8]["n_repeat_words"] and not got[8]["kept"]
    assert quality_rules.keep_good(odd_docs).columns == odd_docs.columns
    assert quality_rules.keep_good(odd_docs.limit(0)).count() == 0


def test_decontamination_equals_sql(spark):
    _against_sql(spark, "op8_decontaminate", ["documents", "benchmark"])


def _leaks_by_brute_force(text, item):
    """Whether a window of the item's shingle count, or the whole of a shorter text, is similar to the item."""
    x, y = ([tuple(w[j:j + 5]) for j in range(len(w) - 4)] for w in (text.split(), item.split()))
    windows = [x[j:j + len(y)] for j in range(max(1, len(x) - len(y) + 1))]
    shared = [(len(w), sum((Counter(w) & Counter(y)).values())) for w in windows]
    return bool(y) and any(10 * s >= 8 * (n + len(y) - s) for n, s in shared)


def test_documents_shorter_than_an_item_leak_it_too(spark):
    rng = random.Random(4)
    items = {n: _four_letters(rng, n) for n in (16, 30, 55)}
    docs = {}
    for n, w in items.items():
        for k in (0, 1, 2, 4, 8, 12):
            docs[100 * n + k] = w[:n - k]
            docs[100 * n + 20 + k] = w[k // 2:n - k // 2] + _four_letters(rng, k // 2)
            docs[100 * n + 40 + k] = _four_letters(rng, 9) + w[k:] + _four_letters(rng, 9)
    docs = {i: " ".join(w) for i, w in docs.items()}
    items = {i: " ".join(w) for i, w in items.items()}
    got = {r["d"]["doc_id"]: r["items"] for r in decontaminate.judge(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
        spark.createDataFrame(list(items.items()), "item_id long, text string"), ["doc_id"]).collect()}
    assert got == {i: [k for k, v in items.items() if _leaks_by_brute_force(t, v)] for i, t in docs.items()}
    assert got[5504] == [55] and got[3001] == [30]


def test_radius_is_all_that_the_blocks_cover():
    flips, blocks = max(bin(m).count("1") for m in decontaminate._flips()), decontaminate.BLOCKS
    assert decontaminate.RADIUS == blocks * (flips + 1) - 1 == 23


def test_extraction_on_held_out_layouts():
    model = html_extract.train(200)
    same = 0
    for seed in range(20_000, 20_060):
        page = html_extract.Page(html_extract.training_page(seed))
        want = html_extract.main_text(page, [int(y) for y in html_extract.labels_of(page)])
        label = html_extract.decode(page.parent, html_extract.gbt.margins(model, html_extract.features(page)))
        assert all(not (label[v] == 1 and label[page.parent[v]] == 2) for v in range(1, len(label)))
        same += html_extract.main_text(page, label) == want
    assert same >= 57
    text = html_extract.extract(model, ["", "<nav><a href=x>menu</a></nav><article><h1>A&amp;B</h1><p>one  two<br>three<p>four "
                                        "five six seven eight.</article><footer>&copy; x</footer>"])
    assert text == ["", "A&B\none two three\nfour five six seven eight."]


def test_base_scores_equal_brute_force_and_model_beats_them(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    out = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows}
    count = Counter(w for r in rows if not out[r["doc_id"]] for w in [*_words(r["text"]), None])
    n, v = sum(count.values()), len(count)
    total = [0.0, 0.0]
    for r in lm_score.score(docs).collect():
        text = next(x["text"] for x in rows if x["doc_id"] == r["doc_id"])
        toks = [*_words(text), None]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[r["doc_id"]], len(toks), n)
        assert r["n_known"] == sum(count[t] > 0 for t in toks)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in toks))
        if r["held_out"]:
            total[0] += r["base_score"]
            total[1] += r["score"]
    assert total[1] > total[0]


def test_audit_finds_exactly_the_damage(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{'x' * (i * 37 % 900)}\r\n\r\n</p>") for i in range(300)]
                                  + [(300, None, None)], "page_id long, url string, html string").repartition(3).cache()
    bad = {7, 120, 299}
    warc.write_replica(pages, str(tmp_path / "a"))
    warc.write_replica(pages.withColumn("html", F.when(F.col("page_id").isin(*bad), F.regexp_replace("html", "^<", "~"))
                                        .otherwise(F.col("html"))), str(tmp_path / "b"))
    first, second = (warc.read_records(spark, str(tmp_path / s)) for s in "ab")
    got = warc.audit(first, second).collect()
    assert len(got) == 301 and {r["page_id"] for r in got if r["status"] == "corrupt"} == bad
    assert {r["status"] for r in got} == {"ok", "corrupt"}
    assert warc.differing_ranges(first, first).count() == 0


def test_repeated_passages_are_covered(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    near = passage[:5] + ["edit"] + passage[6:]
    rows = [(i, " ".join([word() for _ in range(rng.randint(0, 80))] + (near if i == 3 else passage)
                         + [word() for _ in range(rng.randint(0, 80))])) for i in range(6)]
    rows += [(10 + i, " ".join(word() for _ in range(200))) for i in range(6)] + [(20, None), (21, "")]
    got = {r["doc_id"]: r for r in substring_dedup.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(6):
        assert got[i]["n_repeated_words"] >= 54 and len(got[i]["spans"]) == 1
    assert all(got[i]["n_repeated_words"] == 0 for i in (*range(10, 16), 20, 21))


def _four_letters(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n)]


def test_all_copies_of_a_passage_are_one_class_with_its_least_doc(spark):
    rng = random.Random(11)
    first, second = _four_letters(rng, 60), _four_letters(rng, 60)
    texts = {i: _four_letters(rng, 40) + first + _four_letters(rng, 40) for i in (5, 2, 9, 7)}
    texts |= {i: _four_letters(rng, 30) + second + _four_letters(rng, 30) for i in (4, 12, 3, 8, 6)}
    texts[12] = first + _four_letters(rng, 70) + second
    texts |= {20: second[:30], 21: _four_letters(rng, 90)}
    copy = " ".join(_four_letters(rng, 70))
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(31, copy), (30, copy)]
    got = {r["doc_id"]: r for r in substring_dedup.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    holders = [[i for i, w in texts.items() if " ".join(p) in " ".join(w)] for p in (first, second)] + [[30, 31]]
    want = {i: sorted(min(h) for h in holders if i in h) for i in got}
    assert {i: sorted(c["first_doc_id"] for c in r["classes"]) for i, r in got.items()} == want
    assert {i: r["first_doc_id"] for i, r in got.items()} == {i: min(w, default=None) for i, w in want.items()}
    ids = {(c["first_doc_id"], c["class_id"]) for r in got.values() for c in r["classes"]}
    assert len(ids) == 3 == len({c for _, c in ids})


def _similar_by_brute_force(x, cx, y, cy):
    """Longest total of two runs around the anchors whose longest common subsequence makes them similar."""
    def table(p, q):
        best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
        for i in range(len(p)):
            for j in range(len(q)):
                best[i + 1][j + 1] = best[i][j] + 1 if p[i] == q[j] else max(best[i][j + 1], best[i + 1][j])
        return [(i, j, best[i][j]) for i in range(len(p) + 1) for j in range(len(q) + 1)]
    score = [{}, {}]
    for side, cells in zip(score, (table(x[:cx][::-1], y[:cy][::-1]), table(x[cx + 1:], y[cy + 1:]))):
        for i, j, m in cells:
            side[i + j] = max(side.get(i + j, -999), 9 * m - 4 * (i + j))
    return max((s + t for s, p in score[0].items() for t, q in score[1].items() if p + q + 1 >= 0), default=-1) + 2


def test_alignment_equals_brute_force():
    rng = random.Random(8)
    pairs = []
    for n in range(60):
        x = [rng.randrange(10**6) for _ in range(91)]
        y = list(x)
        for _ in range(n % 5):
            at, k = rng.choice([*range(0, 40), *range(52, 80)]), rng.randint(0, 4)
            y[at:at + rng.randint(0, 6)] = [rng.randrange(10**6) for _ in range(k)]
        cy = y.index(x[45]) if x[45] in y else None
        if cy is not None:
            a = max(0, cy - 45)
            pairs.append((np.array(x, np.uint32), 45, np.array(y[a:cy + 46], np.uint32), cy - a))
    got = substring_dedup.matched(pairs)
    for (x, cx, y, cy), g in zip(pairs, got.tolist()):
        want = _similar_by_brute_force(x.tolist(), cx, y.tolist(), cy)
        assert (sum(g) + 2 if g[0] >= 0 else 0) == (want if want >= 2 * substring_dedup.MIN_RUN else 0)
    assert 20 < sum(g[0] >= 0 for g in got.tolist()) < len(pairs)


def test_passages_with_a_word_more_or_less_are_found(spark):
    rng = random.Random(2)
    docs, edited = {}, []
    for k, (n, at) in enumerate([(60, 30), (80, 40), (60, 20), (80, 55)]):
        p = _four_letters(rng, n)
        for e, q in enumerate((p[:at] + ["more"] + p[at:], p[:at] + p[at + 1:])):
            own = p if e else [w + "x" for w in p]
            q = q if e else [w if w == "more" else w + "x" for w in q]
            edited.append((10 * k + 2 * e, 10 * k + 2 * e + 1, n))
            for i, w in zip(edited[-1], (own, q)):
                docs[i] = " ".join(_four_letters(rng, 50) + w + _four_letters(rng, 50))
    got = {r["doc_id"]: r for r in substring_dedup.repeated_passages(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    for a, b, n in edited:
        assert got[a]["n_repeated_words"] >= 0.8 * n and got[b]["n_repeated_words"] >= 0.8 * n, (a, b)
        assert got[a]["first_doc_id"] == got[b]["first_doc_id"] == a


def test_windows_that_the_representative_does_not_match_meet_each_other(spark):
    rng = random.Random(6)
    # All texts hold one line of 16 words; each of five near-equal pairs goes on differently, with a word replaced.
    line, rows, pairs = _four_letters(rng, 16), [(i, None) for i in range(2)], []
    for k in range(5):
        around = _four_letters(rng, 22), _four_letters(rng, 22)
        for i in (10 + 2 * k, 11 + 2 * k):
            p = around[0] + line + around[1]
            if i % 2:
                p[6 if k % 2 else 53] = "edit"
            rows.append((i, " ".join(_four_letters(rng, 30) + p + _four_letters(rng, 30))))
        pairs.append((10 + 2 * k, 11 + 2 * k))
    rows += [(40 + i, " ".join(_four_letters(rng, 40) + line + _four_letters(rng, 40))) for i in range(5)]
    texts = spark.createDataFrame(rows[2:], "doc_id long, text string").select(F.xxhash64("text").alias("tid"), "text", "doc_id")
    tid = {r["doc_id"]: r["tid"] for r in texts.collect()}
    # The windows as if the line held the minimum of all: one key, the anchor in the line.
    at = {r[0]: next(j for j in range(200) if r[1].split()[j:j + 5] == line[4:9]) for r in rows[2:]}
    held = spark.createDataFrame([(1, tid[i], c, 45, 45) for i, c in at.items()],
                                 "key long, tid long, c int, left int, right int")
    none = spark.createDataFrame([], "a long, ca int, b long, cb int, a0 int, a1 int, b0 int, b1 int")
    met = {frozenset((r["a"], r["b"])) for d in substring_dedup._regrouped(held, none, texts.select("tid", "text"))
           for r in d.collect()}
    assert met == {frozenset((tid[a], tid[b])) for a, b in pairs}
    got = {r["doc_id"]: r["first_doc_id"] for r in substring_dedup.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[a] == got[b] == a for a, b in pairs) and all(got[40 + i] is None for i in range(5))


def test_windows_with_enough_elements_in_other_texts_stay(spark, monkeypatch):
    rng = random.Random(4)
    common = _four_letters(rng, 120)
    docs = {i: _four_letters(rng, rng.randint(0, 60)) + common[i * 7 % 50:i * 7 % 50 + rng.randint(30, 70)]
            + _four_letters(rng, 60) for i in range(30)}
    docs[30] = docs[3]
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "tid long, text string")
    rows = [(rng.randint(1, 4), i, c, 45, 45) for i, w in docs.items() for c in rng.sample(range(len(w) - 4), 6)]
    loose = spark.createDataFrame(rows, "key long, tid long, c int, left int, right int").distinct()

    def around(i, c):
        shingles = [tuple(docs[i][j:j + 5]) for j in range(len(docs[i]) - 4)]
        return shingles[max(0, c - 45):c + 46]
    others = lambda key, i: {s for k, j, c, *_ in rows if k == key and j != i for s in around(j, c)}
    want = {r for r in rows if sum(s in others(r[0], r[1]) for s in around(r[1], r[2])) >= substring_dedup.LEAST_SHARED}
    assert 0 < len(want) < len(set(rows))
    elements = substring_dedup.element_table(texts, loose)
    for windows_in_memory in (1 << 14, 40, 0):
        monkeypatch.setattr(substring_dedup, "KEY_WINDOWS", windows_in_memory)
        got = [tuple(r) for r in substring_dedup._plausible(loose, elements).collect()]
        assert len(got) == len(want) and set(got) == want


def test_stored_steps_leave_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        names = disk.getAllFiles().mkString(" ").split()
        return {n for n in names if "shuffle_" in n and n.endswith(".data")}
    there = shuffles()
    df = store.materialise(spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).count(), "shuffled")
    until = time.monotonic() + 20
    while shuffles() - there and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles() - there
    assert df.count() == 5000 and spark.conf.get(setting) == before


def test_verified_pairs_equal_matching_their_surroundings(spark):
    rng = random.Random(5)
    shared = _four_letters(rng, 700)
    docs = {1: _four_letters(rng, 30) + shared, 2: shared[:300] + ["more"] + shared[300:] + _four_letters(rng, 20),
            3: _four_letters(rng, 600) + shared[500:560] + _four_letters(rng, 80), 4: shared[650:],
            5: _four_letters(rng, 40) + shared[600:630] + _four_letters(rng, 40)}
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "tid long, text string")
    elements = substring_dedup.element_table(texts, texts)
    whole = {r["tid"]: np.frombuffer(r["elements"], np.uint32) for r in elements.collect()}
    pairs = [(a, int(p), b, int(q)) for a in docs for b in docs if a < b
             for p, q in zip(*np.nonzero(whole[a][:, None] == whole[b])) if p % 9 == 0 or p < 50]
    cut = lambda w, c: (w[max(0, c - 45):c + 46], min(c, 45))
    want = substring_dedup.matched([(*cut(whole[a], p), *cut(whole[b], q)) for a, p, b, q in pairs])
    got = substring_dedup._verified(spark.createDataFrame(pairs, "a long, ca int, b long, cb int"), elements).collect()
    assert {tuple(r[:4]): tuple(-1 if v is None else v for v in r[4:]) for r in got} == {
        p: tuple(w) for p, w in zip(pairs, want.tolist())} and len(got) == len(pairs)
    assert 0 < (want[:, 0] >= 0).sum() < len(pairs)


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500)
    scored = spark.createDataFrame([(int(t), *map(float, q)) for t, q in zip(rng.integers(1, 900, 500), p)],
                                   "tokens long, p0 double, p1 double, p2 double")
    rate, reached, want = mixing.fit_rates(scored, {"clean": 0.6, "poor": 0.25, "toxic": 0.15})
    assert np.abs(reached - want).max() < 0.02 * want.sum()
    assert scored.select(F.min(rate)).first()[0] >= 0


def test_mixing_drops_toxic_and_keeps_clean(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rated = mixing.mix(docs, spark.read.parquet(f"{SF}/labels.parquet"), keep=["doc_id"])
    assert rated.count() == docs.count() and rated.filter("rate < 0 or rate is null").count() == 0
    unlabelled = mixing.mixed(odd_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert unlabelled.count() == odd_docs.count() and unlabelled.columns == odd_docs.columns


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOC)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_jaccard.similar_components(empty, 3, 90).count() == 0
    assert sharding.shard_rows(empty, 3).count() == 0
    assert substring_dedup.repeated_passages(empty).count() == 0
    assert mixing.mixed(empty, labels).count() == 0
    assert decontaminate.drop_leaks(empty, items).count() == 0
    assert lm_score.score(empty).count() == 0
