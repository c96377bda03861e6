"""Odd and extreme inputs of the operators on training text, and plain versions of those that SQL cannot express."""

from __future__ import annotations

import heapq
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import classifier, embedding_join, ngram_join, quality_rules, scratch, sharding, shipping, url_lists, word_hashes, wrappers

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def fewer_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    shipping.ship(spark)


# -- wrappers ---------------------------------------------------------------------------------


@pytest.mark.parametrize(("html", "want"), [
    ("<p>a<![foo[ y ]]>b", "ab"), ("<![CDATA[x]]><p>a", "a"), ("<p>a<![if IE]>b<![endif]>c", "abc"), ("<p>a<!x y>b", "ab"), ("<!DOCTYPE html><p>a", "a"),
])
def test_odd_declarations_are_comments(html, want):
    assert " ".join(text for _, text in wrappers.parsed(html).blocks) == want


def test_deep_pages(spark):
    deep = ["<div>" * n + f"text {n}" + "</div>" * n for n in (10, 950, 1000, 5000, 100_000)] + ["<article><div class=x>" + "<section>" * 3000 + "inside"]
    rows = [(i, f"http://a.example/{i}", h) for i, h in enumerate(deep)]
    found = {r.page_id: r.text for r in wrappers.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {**{i: f"text {n}" for i, n in enumerate((10, 950, 1000, 5000, 100_000))}, 5: "inside"}


def matches(wrapper, tokens):
    """Whether a wrapper's sequence stands for a sequence of trees, by trying everything."""

    def ends(items, at):
        if not items:
            return {at}
        name, occurs, children = items[0]
        once = lambda p: ends(children, p) if name == "()" else (
            {p + 1} if p < len(tokens) and tokens[p][0] == name and matches(children, tokens[p][1]) else set())
        reached, edge = set(), {at}
        if occurs in ("", "+"):
            edge = once(at)
        reached |= edge
        while occurs in ("+", "*") and edge:
            edge = {q for p in edge for q in once(p)} - reached
            reached |= edge
        if occurs == "?":
            reached |= once(at)
        return {q for p in reached for q in ends(items[1:], p)}

    return len(tokens) in ends(wrapper, 0)


def test_a_wrapper_stands_for_all_its_pages():
    draw = random.Random(4)

    def tree(depth):
        return [["T", []] if not depth or draw.random() < 0.3 else [draw.choice(["ul", "li", "div.a", "div.b"]), tree(depth - 1)] for _ in range(draw.randrange(5))]

    for _ in range(150):
        pages = [["", tree(3)] for _ in range(4)]
        whole = wrappers.folded(pages[0])
        for page in pages[1:]:
            whole = wrappers.merged(whole, wrappers.folded(page))
        assert all(matches(whole[2], page[1]) for page in pages), (whole, pages)


def test_long_sequences_are_aligned_in_parts(monkeypatch):
    monkeypatch.setattr(wrappers, "ALIGNED_PAIRS", 100)
    monkeypatch.setattr(wrappers, "ALIGNED", 8)
    draw = random.Random(5)
    pages = [["", [[draw.choice("abcdefg"), [["T", []]]] for _ in range(n)]] for n in (40, 55, 3)]
    whole = wrappers.folded(pages[0])
    for page in pages[1:]:
        whole = wrappers.merged(whole, wrappers.folded(page))
    assert all(matches(whole[2], page[1]) for page in pages)


def test_an_article_keeps_what_repeats_over_the_host(spark):
    page = "<body><div class=note>Join us</div><article><div class=byline>By Ann Lee</div><p>story {i} of many</article></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i=i)) for i in range(12)]
    found = {r.page_id: r.text for r in wrappers.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {i: f"By Ann Lee\n\nstory {i} of many" for i in range(12)}


# -- URL lists --------------------------------------------------------------------------------


def test_days_far_apart_and_clashing_names(spark):
    last = 2**31 - 1
    entries = [("host:a.example", -(2**31), True), ("host:a.example", 5, False), ("host:b.example", 7, True), ("host:c.example", 0, True), ("host:c.example", last, False)]
    rows = [("http://a.example", -9, "x"), ("http://a.example", 5, "x"), ("http://b.example", last, "x"), ("http://b.example", 6, "x"),
            ("http://c.example", last - 1, "x"), ("http://c.example", last, "x"), ("http://c.example", 2**40, "x")]
    captures = spark.createDataFrame(rows, "url string, day bigint, rule string").withColumn("blocked", F.lit("old"))
    began = time.time()
    found = url_lists.judged(captures, spark.createDataFrame(entries, "pattern string, day int, listed boolean"))
    assert found.columns == ["url", "day", "blocked", "rule"]
    assert Counter((r.url[7], r.day, r.blocked) for r in found.collect()) == Counter([
        ("a", -9, True), ("a", 5, False), ("b", last, True), ("b", 6, False), ("c", last - 1, True), ("c", last, False), ("c", 2**40, False)])
    assert time.time() - began < 120


# -- shards -----------------------------------------------------------------------------------


def test_shards_against_plain_longest_processing_time(spark):
    draw = random.Random(6)
    sizes = [(draw.randrange(1, 1000) ** 2, f"u{i}") for i in range(300)]
    heap, want = [(0, s) for s in range(7)], {}
    for size, unit in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        want[unit] = shard
        heapq.heappush(heap, (load + size, shard))
    assert sharding.longest_first(draw.sample(sizes, len(sizes)), 7) == want
    # With a unit for each group the operator is the plain rule over groups.
    docs = spark.createDataFrame([(i, "x" * draw.randrange(3000, 9000) if i % 3 else "same text") for i in range(60)], "doc_id bigint, text string")
    rows = scratch.stored(sharding.measured(docs, "doc_id", "text"), "t")
    groups = defaultdict(int)
    for r in rows.collect():
        groups[r.group] += r["size"]
    plain = sharding.longest_first([(b, g) for g, b in groups.items()], 4)
    found = sharding.sharded(rows, "doc_id", 4, 1 << 20).collect()
    load = Counter()
    for r in found:
        load[r.shard] += r["size"]
    best = Counter()
    for group, shard in plain.items():
        best[shard] += groups[group]
    assert sorted(load.values()) == sorted(best.values())


def test_one_group_larger_than_all_others(spark):
    docs = spark.createDataFrame([(i, "copy " * 500) for i in range(400)] + [(1000 + i, f"t{i} " * (i % 40)) for i in range(200)], "doc_id bigint, text string")
    found = sharding.sharded(scratch.stored(sharding.measured(docs, "doc_id", "text"), "t"), "doc_id", 6).collect()
    assert len({r.shard for r in found if r.doc_id < 400}) == 1 and {r.shard for r in found} == set(range(6))


# -- vectors ----------------------------------------------------------------------------------


def test_many_equal_vectors(spark):
    rows = spark.range(9000).select(F.col("id").alias("vec_id"), F.when(F.col("id") < 8500, F.array(F.lit(1.0), F.lit(2.0))).otherwise(
        F.array(F.lit(-2.0), F.lit(1.0) + F.col("id") * 1e-9)).alias("embedding"))
    found = embedding_join.near_duplicates(rows).groupBy("component_id", "n_links").count().collect()
    assert sorted(map(tuple, found)) == [(0, 8499, 8500), (8500, 499, 500)]


def test_vectors_are_stored_once_however_many_cells_they_reach(spark, monkeypatch):
    draw = np.random.default_rng(6)
    vectors = [*draw.normal(size=(300, 64)), *draw.normal(size=(2, 30))]
    vectors += [v * 3 for v in vectors[40:60]] + [vectors[0] + draw.normal(size=64) * 0.01]
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(embedding_join, "BLOCK_ROWS", 70)
    monkeypatch.setattr(embedding_join, "CELL_ROWS", 20)
    root = f"{scratch.scratch_root(spark)}/once"
    monkeypatch.setattr(scratch, "scratch_root", lambda _: root)
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.near_duplicates(rows).collect()}
    linked = {0: 322, **{40 + i: 302 + i for i in range(20)}}
    partner = linked | {b: a for a, b in linked.items()}
    assert found == {i: (int(i in partner), min(i, partner.get(i, i))) for i in range(323)}
    written = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(f"{root}/strata-llm")
    assert written.where("unit IS NOT NULL").count() == 323


@pytest.mark.parametrize("most", [0, 100])
def test_of_vectors_with_one_key_the_first_by_value_counts(spark, monkeypatch, most):
    monkeypatch.setattr(embedding_join, "MOST_REPEATED", most)
    vectors = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (3, [1.0, 0.0]), (3, None), (3, [float("nan"), 1.0]), (4, None), (4, [0.01, 1.0]), (5, None), (5, [0.0])]
    rows = spark.createDataFrame([*vectors, (None, [1.0, 0.0]), (None, [1.0, 0.0])], "vec_id bigint, embedding array<double>")
    found = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_join.near_duplicates(rows).collect())
    assert found == {(1, 1, 1, True): 1, (2, 1, 1, False): 1, (3, 1, 3, True): 5, (4, 1, 3, False): 2, (5, 0, 5, True): 2, (None, 0, None, True): 2}


def test_a_matrix_of_links_is_joined_as_its_links_are():
    draw = np.random.default_rng(8)
    for density in (0.0, 0.01, 0.05, 0.5, 1.0):
        near = draw.random((30, 50)) < density
        rows, columns = np.arange(30), np.arange(100, 150)
        one, two = embedding_join._Forest(), embedding_join._Forest()
        one.add_near(near, rows, columns)
        a, b = np.nonzero(near)
        two.add(rows[a], columns[b])
        for forest in (one, two):
            for x in [*rows, *columns]:
                forest.root(int(x))
        groups = [Counter(map(frozenset, _groups(f).values())) for f in (one, two)]
        assert groups[0] == groups[1] and len(one.pairs) == len(two.pairs)


def _groups(forest):
    found = defaultdict(set)
    for x in forest.parent:
        found[forest.root(x)].add(x)
    return found


# -- words ------------------------------------------------------------------------------------


def test_words_of_a_buffer_do_not_depend_on_its_parts(monkeypatch):
    draw = random.Random(9)
    text = b" ".join(bytes(draw.choice(b"abc\xc3\xa9\x00") for _ in range(draw.choice([0, 1, 2, 5, 300, 2000]))) for _ in range(400))
    whole = word_hashes.words(text, b" ", 2)
    assert [text[a:b] for a, b in zip(whole[0], whole[1], strict=True)] == text.split(b" ") if b"  " not in text else text.split()
    for size in (1, 7, 100, 5000):
        monkeypatch.setattr(word_hashes, "CHUNK", size)
        parts = word_hashes.words(text, b" ", 2)
        assert all((x == y).all() for x, y in zip([*whole[:2], *whole[2]], [*parts[:2], *parts[2]], strict=True))
    names = {}
    for a, b, h in zip(whole[0], whole[1], whole[2][0].tolist(), strict=True):
        assert names.setdefault(h, text[a:b]) == text[a:b]
    assert len(names) == len({text[a:b] for a, b in zip(whole[0], whole[1], strict=True)})
    assert len(word_hashes.words(b"", b" ")[0]) == 0


def test_sets_of_texts_taken_together_and_alone():
    texts = [b"", None, b"a", b"a b", b"A\tb\nc d e f", b"x" * 1000 + b" y z w v u", " é b c d e f é".encode(), b" one  two three four ", b"the cat " * 300]
    together = ngram_join.shingle_sets(texts)
    assert [len(s) for s in together] == [0, 0, 1, 1, 2, 2, 3, 1, 2]
    assert all((ngram_join.shingle_sets([t])[0] == s).all() for t, s in zip(texts, together, strict=True))
    assert (ngram_join.shingles("a B c") == ngram_join.shingles("A b\x0bC")).all()


# -- quality ----------------------------------------------------------------------------------


def test_rules_keep_long_texts_and_other_languages(spark):
    finnish = " ".join(f"sana{i} ja" for i in range(40))
    spam = " ".join(f"word{i} shop" for i in range(40))
    long = spark.range(1).select(F.lit(1).alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(1_200_000)), lambda i: F.concat(
        F.when(i % 9 == 0, F.lit("the")).otherwise(F.concat(F.lit("w"), i)))), " ").alias("text"), F.lit("en").alias("lang"))
    rows = [(2, finnish, "fi"), (3, spam, "en"), (4, spam, None), (5, spam, "fr")]
    docs = long.unionByName(spark.createDataFrame(rows, "doc_id int, text string, lang string")).withColumn("_m", F.lit(1)).withColumn("_words", F.lit(2))
    assert sorted(r.doc_id for r in quality_rules.kept(docs).select("doc_id").collect()) == [1, 2, 4]
    judged = quality_rules.judged(docs)
    assert judged.columns == ["doc_id", "text", "lang", "_words", "_m", "_base", "_broken"]
    assert {r.doc_id: r._broken for r in judged.select("doc_id", "_broken").collect()} == {1: [], 2: [], 3: ["stop_words"], 4: [], 5: ["stop_words"]}
    assert quality_rules.kept(docs.drop("lang")).count() == 5


def test_classifier_against_plain_ridge_and_isotonic_fit(spark):
    draw = random.Random(10)
    texts = [" ".join(draw.choice(["good", "words", "here", "the", "and"]) for _ in range(draw.randrange(5, 60))) + (" ### $$$ |||" * (i % 2) * draw.randrange(1, 6)) for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(160)], "doc_id bigint, quality int")
    model = classifier.fit(docs, labels)
    x = np.array([classifier.statistics(t) for t in texts])
    y = np.array([1.0 - i % 2 for i in range(160)])
    scale = np.where(x.std(axis=0) < 1e-9, 1.0, x.std(axis=0))
    z = np.clip((x - x.mean(axis=0)) / scale, -8, 8)
    waves = np.hstack([np.cos(z @ model.frequencies + model.phases) * np.sqrt(2 / len(model.phases)), np.ones((160, 1))])
    gram = waves.T @ waves
    want = np.linalg.solve(gram + 1e-4 * gram[-1, -1] * np.eye(len(gram)), waves.T @ y)
    assert np.allclose(waves @ want, model.features(x) @ model.weights, atol=1e-4)
    # Pool adjacent violators, one at a time.
    score, ones = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [0.0, 2.0, 1.0, 0.0, 3.0, 2.0]
    blocks = [([s], o, 3.0) for s, o in zip(score, ones, strict=True)]
    while any(a[1] / a[2] >= b[1] / b[2] for a, b in zip(blocks, blocks[1:], strict=False)):
        i = next(i for i, (a, b) in enumerate(zip(blocks, blocks[1:], strict=False)) if a[1] / a[2] >= b[1] / b[2])
        a, b = blocks[i : i + 2]
        blocks[i : i + 2] = [(a[0] + b[0], a[1] + b[1], a[2] + b[2])]
    steps, values = classifier.isotonic(np.array(score), np.full(6, 3.0), np.array(ones))
    assert values.tolist() == [o / n for _, o, n in blocks] and steps.tolist() == [sum(s) / len(s) for s, _, _ in blocks]


def test_classifier_with_clashing_names_and_an_empty_table(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(8)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id bigint, quality int")
    wide = docs.withColumn("_row", F.lit(1)).withColumn("_text", F.lit("x")).withColumn("statistics", F.lit(2)).withColumn("_key", F.lit(3)).withColumn("_label", F.lit(4)).withColumn("fold", F.lit(5))
    model = classifier.fit(wide, labels)
    assert classifier.accepted(wide, model, 0.0).columns == wide.columns and classifier.accepted(wide, model, 0.0).count() == 8
    assert classifier.accepted(docs.limit(0), classifier.fit(docs.limit(0), labels), 0.0).count() == 0


def test_stages_of_an_empty_table_with_all_labels(spark):
    empty = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0
