"""Ranked search, phrase collocations and the mix of sources against brute force, on small and odd tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import collocations, lexical_search, mixing, shipping

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} and more{i % 1013}" for i in range(30_000))


@pytest.fixture(autouse=True)
def fewer_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    shipping.ship(spark)


def some_texts(n=120):
    draw = np.random.default_rng(11)
    words = [f"w{i}" for i in range(9)] + ["Über", "é", "日本", "x1", "THE", "the", "The"]
    ends = [" ", " ", " ", ". ", ", ", "\n", "\t", "-"]
    texts = ["".join(f"{draw.choice(words)}{draw.choice(ends)}" for _ in range(int(draw.integers(0, 60)))) for _ in range(n)]
    return [*texts, *texts[:20], "", " ", "\n", "...", None, None, "a b c d " * 400, LONG]


# -- ranked search ----------------------------------------------------------------------------


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, top):
    held = [(key, Counter(plain_terms(text))) for key, text in docs]
    held = [(key, c) for key, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in set(items):
        rows = []
        for key, c in held:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(plain_terms(text)) if t in c)
            if score > 0:
                rows.append((-score, key is None, key or 0))
        out.update((item, rank, None if none else key, -score) for rank, (score, none, key) in enumerate(sorted(rows)[:top], 1))
    return out


def test_search_against_brute_force(spark, monkeypatch):
    texts = some_texts()
    docs = [(None if i % 40 == 7 else i // 2 * 3, t) for i, t in enumerate(texts)]  # ids that repeat, and null ones
    items = [(1, "w1 w2 THE"), (2, "the"), (2, "w3 w3 w4"), (3, None), (4, "..."), (5, "nowhere"), (6, texts[0]), (1, "w1 w2 THE"), (None, "é 日本"), (7, "word1 a")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("rank", F.lit("x")).withColumn("n", F.lit(1)).repartition(5)
    asked = spark.createDataFrame(items, "item_id int, text string").withColumn("query", F.lit(0)).withColumn("item", F.lit(0))
    for top, block in ((10, lexical_search.BLOCK_ITEMS), (3, 2)):
        monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", block)
        found = lexical_search.search(frame, asked, top=top)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, found.collect())) == plain_search(docs, items, top)


def test_search_in_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs.withColumn("text", F.lit("?")), items).count() == 0
    assert [tuple(r) for r in lexical_search.search(docs, items).collect()][0][:3] == (1, 1, 1)


def test_scores_of_very_long_documents_do_not_overflow():
    n, documents, total = np.array([10**9]), 10**11, 10**14
    norm = 10 + (90 * 10**9 * documents) // total
    assert lexical_search.saturated(np.array([5]), n, documents, total).tolist() == [5 * 10**9 // (5000 + 8 * norm)]


# -- phrases ----------------------------------------------------------------------------------


def plain_counts(rows):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f, n


def plain_collocations(rows, least, top):
    f, n = plain_counts(rows)
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            inside = [b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            cuts = [((2_000_000 * a) // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return Counter(out)


def test_collocations_against_brute_force(spark, monkeypatch):
    langs = ["en", "en", "fr", None, "und", ""]
    rows = [(langs[i % 6], t) for i, t in enumerate([*some_texts(), "new york city. New York City\tnew york city! san\x0cfrancisco " * 12, "x\x01y z\xa0 x\x01y z\xa0 " * 9])]
    frame = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("rank", F.lit(1)).repartition(3)
    monkeypatch.setattr(collocations, "BLOCK_MASS", 500)
    monkeypatch.setattr(collocations, "HELD_PHRASES", 300)
    for least, top, bits in ((5, 2000, collocations.FILTER_BITS), (8, 7, 1024)):
        monkeypatch.setattr(collocations, "FILTER_BITS", bits)  # a full filter lets everything through, and nothing changes
        monkeypatch.setattr(collocations, "WINDOW_ROWS", 20)
        found = collocations.collocations(frame, least=least, top=top)
        want = plain_collocations(rows, least, top)
        assert Counter(map(tuple, found.collect())) == want and len(want) > 12
    assert collocations.collocations(frame.limit(0)).count() == 0
    assert collocations.collocations(frame.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_exact_counts_of_frequent_phrases(spark):
    rows = [("en", "the cat sat. the cat sat, the dog") for _ in range(3)]
    found = {(r.words, r.phrase): r.f for r in collocations.frequent(spark.createDataFrame(rows, "lang string, text string"), least=6).collect()}
    assert found == {(0, ""): 24, (1, "the"): 9, (1, "cat"): 6, (1, "sat"): 6, (2, "the cat"): 6, (2, "cat sat"): 6, (3, "the cat sat"): 6}


@pytest.mark.parametrize(("least", "counters", "slack"), [(30, 64, 4), (30, 2560, 8), (5, 16, 1), (2, 8, 1), (1, 8, 1)])
def test_summaries_lose_nothing_frequent(least, counters, slack):
    draw = np.random.default_rng(least + counters)
    stream = np.concatenate([draw.integers(0, 1 << 40, 400_000), np.repeat(np.arange(50, dtype=np.int64), least), draw.zipf(1.3, 20_000) % 30_000]).astype(np.uint64)
    draw.shuffle(stream)
    summary = collocations.Summary(least, slack, counters)
    for part in np.array_split(stream, 97):
        names, counts = np.unique(part, return_counts=True)
        summary.add(names, counts)
    names, counts = np.unique(stream, return_counts=True)
    kept = set(summary.survivors().tolist())
    assert set(names[counts >= least].tolist()) <= kept and summary.error < least and summary.mass == len(stream)
    if least == 30:
        assert len(summary.names) <= 8 * slack * len(stream) // least + 1 and 2 * len(summary.names) < len(names)


def test_word_hashes_depend_on_words_and_language_alone():
    one, two = collocations.Words([b"ab cd", b"AB\tcd.ef"], "en", 2), collocations.Words([b"zz ab cd"], "en", 2)
    assert one.grams(2)[0] == one.grams(2)[2] == two.grams(2)[1] and one.grams(2, 1)[0] == two.grams(2, 1)[1]
    assert one.whole(2).tolist() == [True, False, True, False] and one.phrase(2, 2) == b"ab cd"
    assert collocations.Words([b"ab cd"], "fr").grams(2)[0] != one.grams(2)[0] and len(collocations.Words([b"", b" . "], "en")) == 0


# -- mixing -----------------------------------------------------------------------------------


def plain_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in stopped]
        level = Fraction(total - sum(3 * sizes[s] for s in stopped), sum(weight[s] for s in rest)) if rest else Fraction(0)
        above = {s for s in rest if 3 * sizes[s] <= level * weight[s]}
        if not above:
            return {s: Fraction(3 * sizes[s]) if s in stopped else level * weight[s] for s in order}
        stopped |= above


def mix_docs(spark):
    texts = some_texts(200)
    sources = ["a", "b", "b", "c", None, "Z", "é", "tiny", "b"]
    rows = [(i if i % 50 else None, t, None, "tiny" if i == 3 else "void" if t == "" else sources[i % 9] if sources[i % 9] != "tiny" else "c", None) for i, t in enumerate(texts)]
    rows += [(7, "same row of a group", None, "b", None)] * 300
    return rows, spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("x")).withColumn("taken", F.lit(0)).withColumn("_block", F.lit(0)).repartition(6)


def test_mix_against_its_law(spark):
    rows, frame = mix_docs(spark)
    found = mixing.mixed(frame, keep=("doc_id", "text", "source")).collect()
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += plain_size(text)
    want = plain_targets(sizes)
    assert math.isclose(sum(float(t) for t in want.values()), sum(sizes.values()))
    assert Counter((r.doc_id, r.source, r["size"]) for r in found) == Counter((k, s, plain_size(t)) for k, t, _, s, _ in rows)
    taken, largest = Counter(), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, float(want[r.source]), rel_tol=1e-12)
        assert r.taken == r["size"] * r.copies <= 3 * r["size"] and r.copies in range(4)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        assert (r.row.doc_id, plain_size(r.row.text), r.row.source) == (r.doc_id, r["size"], r.source)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 for s in sizes)
    # Whole epochs first, then documents in the order of their keys.
    for s in sizes:
        own = sorted((r.draw, r.doc_id is not None, r.doc_id or 0, r["size"], -r.copies) for r in found if r.source == s and sizes[s])
        copies = [-c for *_, c in own]
        assert copies == sorted(copies, reverse=True) and set(copies) <= {int(want[s] // sizes[s]), int(want[s] // sizes[s]) + 1} if copies else True
    again = mixing.mixed(frame.repartition(3)).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in again) == Counter((r.doc_id, r["size"], r.taken) for r in found)


def test_draws_are_the_exponential_keys(spark):
    frame = spark.createDataFrame([(5, "a b c # d", None, "s", None), (None, None, None, "s", None)], DOCS)
    got = {r.doc_id: r for r in mixing.mixed(frame).collect()}
    u = (int(hashlib.md5(b"mix:5").hexdigest()[:13], 16) + 0.5) / 2**52
    assert math.isclose(got[5].weight, 5 / 15) and math.isclose(got[5].draw, -math.log(u) * 3) and got[None].weight == 1.0


def test_the_mix_itself(spark):
    rows, frame = mix_docs(spark)
    mix = mixing.mixed(frame, keep=frame.columns)
    whole = mixing.repeated(mix)
    assert whole.columns == [*frame.columns, "_epoch"]
    assert whole.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == mix.agg(F.sum("taken")).first()[0]


def test_mix_of_odd_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mixed(empty).count() == 0
    none = spark.createDataFrame([(1, None, None, None, None), (2, " ", None, "a", None)], DOCS)
    assert [(r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in mixing.mixed(none).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    one = spark.createDataFrame([(i, "a b", None, "only", None) for i in range(5)], DOCS)
    assert {(r.target, r.taken) for r in mixing.mixed(one).collect()} == {(10.0, 2)}


def test_no_python_in_the_mix(spark):
    plan = mixing.mixed(spark.createDataFrame([(1, "a b", None, "s", None)], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
