"""The operators on training text against brute force, on small and odd tables."""

from __future__ import annotations

import base64
import json
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import (
    byte_bpe, classifier, components, embedding_join, ngram_join, numbering, packing, quality_rules, queries, scratch, sharding, token_files,
    url_lists, wrappers,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} and more{i % 1013}" for i in range(30_000))
ODD = ["", " ", "\n", "a", "A a", "one two three four five six", "One two three four five six", "x\ty  z w\x1c end ", "日本語 テスト é́", "don't we'll <|endoftext|>", LONG]


@pytest.fixture(autouse=True)
def fewer_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def odd_docs(spark):
    texts = [*ODD, *ODD, None, None]
    return spark.createDataFrame([(i if i != 3 else None, t, None, "s", None) for i, t in enumerate(texts)], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_numbers_have_no_gaps_within_a_hot_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 5).alias("k"), (F.col("id") % 300).alias("v"))
    found = numbering.numbered(rows, ["k"], ["v"], "n", 16).collect()
    by = defaultdict(list)
    for r in found:
        by[r.k].append(r.n)
    assert len(found) == 1000 and all(sorted(x) == list(range(len(x))) for x in by.values())


PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header>H</header><div class='cookie-notice'>c</div>{main}"
    "<div id='comments'><article class=comment>bad</article></div><aside>s</aside><form>f</form><script>var t='</p>';</script></body></html>")


def test_page_text(spark):
    main = "<{0}><h1>A &amp;  B</h1><p><b>one<br>two<p>three<ul><li>x<li>y</ul><nav>menu</nav></{0}>"
    rows = [(1, "http://a.example/1", PAGE.replace("{main}", main.format("article"))), (2, "http://a.example/2", PAGE.replace("{main}", main.format("main"))),
            (3, "http://b.example", None), (4, None, "<p>only"), (None, "http://b.example", ""), (1, "http://a.example/1", PAGE.replace("{main}", main.format("article")))]
    found = wrappers.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    want = "A & B\n\none two\n\nthree\n\nx\n\ny"
    assert Counter((r.page_id, r.text) for r in found) == Counter({(1, want): 2, (2, want): 1, (3, ""): 1, (4, "only"): 1, (None, ""): 1})
    assert wrappers.extracted(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


@pytest.mark.parametrize(("html", "want"), [
    ("<body><article><p>a<datalist id=d><option>x<option>y</datalist><p>b</article>", "a b"),
    ("<body><article><p>a<select><option>x<option>y</select><p>b<option>x<p>c</article>", "a b c"),
    ("<html><head><meta charset=utf-8><title>t</title><p>a<article>b</article>", "a b"),
    ("<html><head><title>t</title><noscript><p>n</noscript><article>a</article>", "a"),
    ("<html><head><title>t</title><h1>a</h1>b</head><body>c", "a b c"),
    ("<html><head><title>t</title> a", "a"),
    *((f"<body><article><div><p>a<{tag}><p>x</div><p>b</article>", "a x b") for tag in ("button", "iframe", "object", "noscript", "template", "canvas")),
    *((f"<body><article><p>a<{tag}><div><p>x</div></{tag}><p>b</article>", "a b") for tag in ("button", "iframe", "object", "noscript", "template", "canvas")),
    ("<body><p>a<noscript><p>b<button>c</button>", "a b"),
    ("<body><div>a<textarea></div></textarea>b</div><title>c", "ab c"),
    ("<body><p>a<script>if (x < y) '</p><p>b'", "a"),
    ("<body><p>a<svg><title>x</title><g/></svg>b<video src=v><p>x</video>c", "abc"),
])
def test_hidden_elements_end(html, want):
    assert " ".join(" ".join(text for _, text in wrappers.parsed(html).blocks).split()) == want


MAIN = "<article><div class=entry-header><h1>a</h1></div><p>long text of it</article>"


@pytest.mark.parametrize(("html", "want"), [
    *((f"<html class=no-sidebar><body class='{c}'>{MAIN}<div class='sidebar-left'>s</div></body>", "a long text of it")
      for c in ("single has-sidebar", "no-sidebar", "sidebar", "hidden", "form")),
    *((f"<body><div class='{c}'>{MAIN}</div><div class='main-nav'>n</div>", "a long text of it") for c in ("overflow-hidden", "content-widget", "widget", "with-comments")),
    (f"<body><form id=f><nav>n</nav><div class=toolbar>{MAIN}</div></form><footer>f</footer>", "a long text of it"),
    ("<body><form><div class=x><p>no article but most of the text</div><div class=cookie-bar>c</div></form><p>t", "no article but most of the text t"),
    ("<body><article><header><h1>a</h1></header><div class=header>b</div><nav>n</nav>c<div class=related-posts>r</div></article><header>h</header>", "a b c"),
    ("<body><main>short</main><div class='sidebar'><article>a longer teaser than the page</article></div>", "short"),
    ("<body><div class=x>short</div><div id=comments><article>a longer comment than the page</article></div>", "short"),
    ("<body><div class='site-header'>h</div><div class='page-header'>a</div><p>b</p><div class='ad-banner'>c</div>", "a b"),
    ("<body><div class=post-content>a</div><div class=x>b</div>", "a"),
])
def test_only_containers_beside_the_article_are_aside(html, want):
    page = wrappers.parsed(html)
    assert " ".join(wrappers.main_text(page, wrappers.main_slots(wrappers.folded(page.tree))).split()) == want


def test_slots_that_repeat_their_texts_over_a_host_are_template(spark):
    def page(i, host="a"):
        return f"http://{host}.example/{i}", f"<body><div class=x>Join us today</div><div class=y><p>Story {i} of many<p>and more {i}</div></body>"

    rows = [(i, *page(i)) for i in range(6)] + [(6, "http://a.example/6", "<body><div class=x>Join us today</div></body>")]
    rows += [(10 + i, *page(i, "few")) for i in range(4)] + [(20 + i, *page(0, "copies")) for i in range(8)]
    found = {r.page_id: r.text for r in wrappers.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [found[i] for i in range(6)] == [f"Story {i} of many\n\nand more {i}" for i in range(6)] and found[6] == "Join us today"
    assert all(found[10 + i] == f"Join us today\n\nStory {i} of many\n\nand more {i}" for i in range(4))
    assert {found[20 + i] for i in range(8)} == {"Join us today\n\nStory 0 of many\n\nand more 0"}


def test_wrappers_of_a_hot_host_are_merged_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "GROUP", 3)
    rows = [("http://a.example/", "<article>" + "".join(f"<div class=k{chr(97 + i // 2 ** j % 2)}{chr(97 + j)}>x</div>" for j in range(6)) + "</article>") for i in range(64)]
    rows += [("http://b.example/", "<p>b")]
    found = wrappers.wrappers(spark.createDataFrame(rows, "url string, html string"))
    got = {r.host: {"/".join(p) for p in wrappers.slots(json.loads(r.wrapper))} for r in found.collect()}
    assert got == {"a.example": {f"article/div.k{c}{chr(97 + j)}" for c in "ab" for j in range(6)}, "b.example": {""}} and found.count() == 2
    assert found._jdf.queryExecution().analyzed().toString().count("FlatMapGroupsInPandas") >= 4


def test_wrapper_aligns_into_optional_and_repeated_groups():
    one, two = (wrappers.folded(wrappers.parsed(h).tree) for h in ("<ul><li>a<li>b</ul><div>x</div>", "<ul><li>a</ul><section>y</section><div>x</div>"))
    assert wrappers.expression(wrappers.merged(one, two)) == "<ul> (<li> T </li>)+ </ul> (<section> T </section>)? <div> T </div>"


def test_url_lists(spark):
    entries = [("host:a.example", 10, True), ("host:a.example", 20, False), ("host:a.example", 20, True), ("host:a.example", 90, False),
               ("domain:b.example", 5, True), ("path:c.b.example/x/", 50, True), (None, 1, True), ("host:z", None, True)]
    urls = [("http://A.example/p", 9), ("http://a.example:80/p", 10), ("http://u@a.example", 89), ("http://a.example", 90), ("http://c.b.example/x/y", 49),
            ("http://c.b.example/x/y", 50), ("http://xb.example", 60), (None, 5), ("no url", 5), ("http://c.b.example", None), ("http://a.example", 89), ("http://a.example", 89)]
    captures = spark.createDataFrame([(u, d, i) for i, (u, d) in enumerate(urls)], "url string, day int, rule int")
    listed = spark.createDataFrame(entries, "pattern string, day int, listed boolean")
    found = url_lists.judged(captures.withColumnRenamed("rule", "id"), listed).orderBy("id").collect()
    host, domain, path = "host:a.example", "domain:b.example", "path:c.b.example/x/"
    assert [r.rule for r in found] == [None, host, host, None, domain, path, None, None, None, None, host, host]
    assert url_lists.judged(captures.where("false").withColumnRenamed("rule", "id"), listed.where("false")).count() == 0


def test_shards_keep_groups_and_level_bytes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs(spark))
    rows = scratch.stored(sharding.measured(docs, "doc_id", "text"), "t")
    for units in (sharding.UNITS, 96):
        found = sharding.sharded(rows, "doc_id", 5, units).collect()
        shard = defaultdict(set)
        slots = defaultdict(list)
        load = Counter()
        for r in found:
            shard[r.group].add(r.shard)
            slots[r.shard].append(r.slot)
            load[r.shard] += r["size"]
        assert len(found) == docs.count() and all(len(s) == 1 for s in shard.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        group = Counter()
        for r in found:
            group[r.group] += r["size"]
        assert max(load.values()) <= max(sum(load.values()) / 5 + 40_000, max(group.values()))
    assert sharding.sharded(scratch.stored(sharding.measured(empty_docs(spark), "doc_id", "text"), "t"), "doc_id", 5).count() == 0


def test_packing_against_the_lower_bound_and_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    docs = odd_docs(spark)
    rows = packing.pack(docs, path).collect()
    want = Counter()
    for r in docs.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for i, at in enumerate(range(0, len(ids), 2048)):
            want[(r.doc_id, i, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        ends = np.cumsum([length for _, length in sorted(b)])
        assert [o for o, _ in sorted(b)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(bins) == -(-sum(r.length for r in rows) // 2048)
    assert packing.pack(empty_docs(spark), path).count() == 0
    whole = packing.sequences(docs, path).collect()
    assert sorted(len(r.ids) // 4 for r in whole) == sorted(sum(length for _, length in b) for b in bins.values())


def test_bin_completion_beats_best_fit():
    counts = {6: 2, 5: 2, 4: 2, 3: 4, 2: 1}
    best = packing.packed_bins(counts, 10)
    assert sum(t for t, _ in best) == 5 and all(sum(f) <= 10 for _, f in best)
    packed = Counter()
    for times, filling in best:
        for length in filling:
            packed[length] += times
    assert packed == Counter(counts) and packing.packed_bins({}, 10) == []


@pytest.mark.parametrize(("counts", "capacity", "most"), [
    ({13: 1, 7: 1, 8: 1, 10: 2, 12: 2, 15: 1}, 30, 3),
    ({27: 1, 49: 1, 36: 1, 13: 1, 23: 1, 43: 1, 44: 1, 58: 1}, 100, 3),
])
def test_packing_branches_where_best_fit_misses_the_bound(counts, capacity, most):
    assert all(sum(t for t, _ in make(counts, capacity)) > most for make in (packing.best_fit, packing.next_fillings))
    best, proved = packing.searched(counts, capacity)
    packed = Counter()
    for times, filling in best:
        assert sum(filling) <= capacity
        packed.update({length: times * n for length, n in Counter(filling).items()})
    assert proved and sum(t for t, _ in best) == most and packed == Counter(counts)
    assert sum(t for t, _ in packing.packed_bins(counts, capacity)) == most and not packing.searched(counts, capacity, steps=1)[1]


def test_best_fit_takes_the_bin_with_the_least_room():
    # The two of length 3 go beside 7, not into the room that 6 leaves.
    assert sorted(packing.best_fit({6: 1, 7: 2, 3: 2}, 10)) == [(1, (6,)), (2, (7, 3))]


def test_token_files_round_trip(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    docs = odd_docs(spark)
    to = scratch.folder(spark, "files")
    index = token_files.write(docs, path, to)
    back = token_files.read(index, to).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None, *[i for i in range(24) if i != 3]]
    texts = {r.doc_id: r.text for r in docs.collect()}
    start = 0
    for r in back:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert ids == [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2] and r.start == start and r.n_tokens == len(ids)
        start += len(ids)
    some = token_files.read(index.where("doc_id IN (5, 21)"), to).collect()
    assert {r.doc_id: bytes(r.ids) for r in some} == {r.doc_id: bytes(r.ids) for r in back if r.doc_id in (5, 21)}
    empty = scratch.folder(spark, "files")
    assert token_files.read(token_files.write(empty_docs(spark), path, empty), empty).count() == 0


def test_embedding_join_against_brute_force(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(60, 8))
    vectors = [*base, *(base[:30] + draw.normal(size=(30, 8)) * 0.12), *([base[0]] * 25)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, []), (905, [1.0, 2.0]), (None, rows[0][1])]
    embedding_join.BLOCK_ROWS, embedding_join.CELL_ROWS, kept = 16, 20, (embedding_join.BLOCK_ROWS, embedding_join.CELL_ROWS)
    try:
        found = embedding_join.near_duplicates(spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")).collect()
    finally:
        embedding_join.BLOCK_ROWS, embedding_join.CELL_ROWS = kept
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    reach = np.linalg.matrix_power(near.astype(float), 64) > 0
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    for i in range(len(vectors)):
        first = int(np.flatnonzero(reach[i])[0])
        assert got[i] == (int(near[i].sum()) - 1, first, first == i)
    assert all(got[i][:2] == (0, i) for i in range(900, 906))
    assert embedding_join.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<double>")).count() == 0


def test_byte_bpe_as_the_library(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = odd_docs(spark).unionByName(spark.createDataFrame([(99, "ab" * 300 + " " * 50, None, None, None)], DOCS))
    found = byte_bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).withColumn("bytes", byte_bpe.decode(F.col("ids"), path)).collect()
    got = {r.doc_id: (r.ids, bytes(r.bytes)) for r in found}
    for r in docs.collect():
        assert got[r.doc_id] == (library.encode_ordinary(r.text or ""), (r.text or "").encode())
    assert byte_bpe.encode(empty_docs(spark).select("doc_id", "text"), path, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_of_many_and_long_words(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pieces = byte_bpe.load(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})
    draw = np.random.default_rng(4)
    letters = lambda n, of="abcdefghijklmnopqrstuvwxyz": "".join(draw.choice(list(of), n))
    # Pieces side by side: a merge may bring a lesser rank about.
    known = [p.decode() for p in pieces if p.isalpha() and p.isascii() and len(p) > 2]
    texts = [letters(20_000), "ab" * 9_000, "a" * 7_001, "=" * 5_000, " ".join(letters(int(n)) for n in draw.integers(2, 20, 20_000)),
             " ".join("".join(draw.choice(known, int(n))) for n in draw.integers(2, 5, 40_000)), " ".join(letters(int(n), "aab") for n in draw.integers(5, 60, 3_000)),
             " ".join(letters(5, "日本語テストé́ñ") for _ in range(3_000)), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    began = time.time()
    found = {r.doc_id: r.ids for r in byte_bpe.encode(docs, path, public_tokenizers.PATTERN).collect()}
    assert time.time() - began < 30
    assert found == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}


def brute_components(rows):
    sets = {}
    for key, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: (len(s), root(k)) for k, s in sets.items()}


def test_ngram_join_against_brute_force(spark):
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for size in (4, 7, 9, 20, 60, 200):
        base = list(draw.choice(words, size))
        for _ in range(25):  # a group of near copies, and a line that all share
            copy = list(base)
            for at in draw.integers(0, size, max(1, size // 60)):
                copy[at] = "new" + str(draw.integers(9))
            texts.append(" ".join(copy) + draw.choice(["", " common line that many documents share here"]))
    rows = [(i * 3, t) for i, t in enumerate([*texts, *ODD, *ODD, None])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_components(rows)
    for per_row in (ngram_join.PAIRS_PER_ROW, 0):
        ngram_join.PAIRS_PER_ROW, kept = per_row, ngram_join.PAIRS_PER_ROW
        try:
            found = ngram_join.join(docs.union(spark.createDataFrame([(None, texts[0])], docs.schema))).collect()
        finally:
            ngram_join.PAIRS_PER_ROW = kept
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == want
    stay = ngram_join.representatives(docs.union(docs.limit(1)).withColumn("_rows", F.lit(1)))
    assert sorted(r.doc_id for r in stay.collect()) == sorted(k for k, (_, c) in want.items() if k == c) and stay.columns == ["doc_id", "text", "_rows"]
    assert ngram_join.join(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("longest", [0, 3])
def test_ngram_join_with_lists_of_any_length(spark, monkeypatch, longest):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", longest)
    draw = np.random.default_rng(8)
    rows = []
    for size in (5, 12, 80):
        base = [f"v{i}" for i in draw.integers(0, 500, size)]
        for copies in (2, 3, 9):
            base = [*base[: size // 2], *(f"u{i}" for i in draw.integers(0, 500, size - size // 2))]
            rows += [(len(rows) + i, " ".join([*base, *(["end"] * int(draw.integers(3)))])) for i in range(copies)]
    found = ngram_join.join(spark.createDataFrame([*rows, (900, rows[0][1])], "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components([*rows, (900, rows[0][1])])


def test_short_lists_go_no_further_than_where_they_are_gathered(spark, monkeypatch):
    # Each two texts share a passage, but not enough to link; each third pair links.
    rows = []
    for i in range(40):
        shared = [f"s{i}x{k}" for k in range(36)]
        rows += [(2 * i + j, " ".join([*shared, *(f"t{i}y{j if i % 3 else 0}z{k}" for k in range(24)), f"e{j}"])) for j in range(2)]
    counts = defaultdict(int)

    def counted(df, name):
        df = scratch.stored(df, name)
        counts[name] += df.count()
        return df

    monkeypatch.setattr(ngram_join, "stored", counted)
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows)
    assert counts["ngram-links"] == 14 and counts["ngram-lists"] == 0 and counts["ngram-rest"] == 0


def test_representatives_of_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    near = lambda t: t + " end"
    rows = [(1, a), (1, a), (1, b), (2, c), (5, near(c)), (5, d), (6, ""), (6, None), (7, near(d)), (8, "x"), (8, "y"), (8, "x"), (9, near(b)), (None, a), (None, a)]
    found = Counter((r.doc_id, r.text) for r in ngram_join.representatives(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    empty = found.pop((6, ""), 0) + found.pop((6, None), 0)
    assert empty == 1 and found == Counter({(1, a): 1, (1, b): 1, (2, c): 1, (5, d): 1, (8, "x"): 1, (8, "y"): 1, (None, a): 2})
    both = ngram_join.representatives(spark.createDataFrame([(1, a), (1, near(a)), (2, a)], "doc_id bigint, text string")).collect()
    assert len(both) == 1 and both[0].doc_id == 1


def shuffled_bytes(frame):
    """Bytes that the exchanges of a plan have dealt."""
    frame.collect()
    found = []

    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("dataSize").value())
        for i in range(node.children().length()):
            walk(node.children().apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return sum(found)


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_representatives_shuffle_no_text_that_the_ids_decide(spark, monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "FILTER_BITS", bits)
    texts = [" ".join(f"v{i}x{k}" for k in range(400)) for i in range(120)]
    rows = [*enumerate(texts), *((1000 + i, texts[i] + " end") for i in range(0, 120, 3)), (5, texts[5]), (6, texts[7]), (1000, texts[8]), (None, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stay = ngram_join.representatives(scratch.stored(docs, "documents"))
        dealt = shuffled_bytes(stay)
        assert Counter(map(tuple, stay.collect())) == Counter([(6 if i == 7 else i, t) for i, t in enumerate(texts)] + [(None, texts[9])])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert bits == 64 or dealt < sum(len(t) for _, t in rows) / 5


def test_sketches_never_rule_out_a_link(spark):
    rng = np.random.default_rng(5)
    sets, pairs = {}, []
    for i in range(120):
        n = int(rng.choice([4, 9, 60, 64, 65, 127, 128, 129, 600]))
        one = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut, new = rng.integers(0, max(1, n // 6), 2)
        two = np.concatenate([one[cut:], rng.integers(0, 1 << 63, int(new)).astype(np.uint64)])
        sets[2 * i], sets[2 * i + 1] = np.unique(one), np.unique(two)
        pairs.append((2 * i, 2 * i + 1))
        if i % 3 == 0 and 100 * n >= 80 * len(one):
            far = np.unique(rng.integers(0, 1 << 63, len(sets[2 * i])).astype(np.uint64))
            sets[1000 + i] = far
            pairs.append((2 * i, 1000 + i))
    bits = [(0, 0, len(s), k, [int(w) for w in ngram_join.sketch(s)]) for k, s in sets.items()]
    scan = spark.createDataFrame(bits, "kind int, id bigint, a bigint, b bigint, sketch array<bigint>")
    near = {tuple(r) for r in ngram_join._near(spark.createDataFrame(pairs, "a bigint, b bigint"), scan).collect()}
    for a, b in pairs:
        common = len(np.intersect1d(sets[a], sets[b]))
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            assert (a, b) in near
    assert not any(b >= 1000 and len(sets[a]) >= 60 for a, b in near)


def test_quality_rules_on_odd_texts(spark):
    line = "one two three four five six seven"
    docs = spark.createDataFrame([(1, f"{line}\n{line}\n"), (2, None), (3, "a#b $ c"), (4, " ".join(f"the w{i}" for i in range(60)))], "doc_id bigint, text string")
    found = {r.doc_id: r for r in quality_rules.judged(docs).select("doc_id", "_m", "_base", "_broken").collect()}
    assert (found[1]._m.n_words, found[1]._m.n_dup_lines, found[1]._m.n_repeat_words) == (14, 1, 14)
    assert found[2]._m.n_words == 0 and found[2]._base == ["words"] and found[3]._m.n_symbols == 2 and found[3]._m.word_chars == 5
    assert found[4]._base == [] and found[4]._broken == []
    clash = docs.withColumn("_words", F.lit(1)).withColumn("_m", F.lit(2))
    assert quality_rules.kept(clash).columns == clash.columns and quality_rules.kept(empty_docs(spark)).count() == 0


def test_isotonic_never_falls():
    steps, values = classifier.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([4.0, 4, 4, 4]), np.array([0.0, 3, 1, 4]))
    assert (np.diff(values) > 0).all() and values.tolist() == [0.0, 0.5, 1.0] and len(steps) == 3


def test_classifier_on_held_out_rows(spark):
    found = queries.op10_quality_classifier(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    rows = found.collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.93
    docs = odd_docs(spark)
    flat = classifier.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.s for r in docs.select(classifier.score(flat, F.col("text")).alias("s")).collect()} == {0.5}
    some = classifier.fit(docs, spark.createDataFrame([(0, 1), (0, 1), (5, 0), (10, 0), (None, 1), (6, None)], "doc_id bigint, quality int"))
    assert docs.where(classifier.score(some, F.col("text")).between(0, 1)).count() == docs.count()
    assert classifier.accepted(empty_docs(spark), some, 0.5).count() == 0


def test_pipeline_against_plain_stages(spark):
    sf = SF
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = scratch.stored(corpus_pipeline.quality_classifier(spark, docs, sf), "p")
    second = scratch.stored(corpus_pipeline.rules(spark, first, sf), "p")
    third = scratch.stored(corpus_pipeline.near_duplicates(spark, second, sf), "p")
    assert first.columns == second.columns == third.columns == docs.columns
    want = brute_components([(r.doc_id, r.text) for r in second.collect()])
    assert sorted(r.doc_id for r in third.collect()) == sorted(k for k, (_, c) in want.items() if k == c)
    last = corpus_pipeline.packed(spark, third, sf).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in third.collect()}
    assert len({r.sequence_id for r in last}) == -(-sum(r.length for r in last) // 2048)
    assert corpus_pipeline.run(spark, sf).count() == len(last)
