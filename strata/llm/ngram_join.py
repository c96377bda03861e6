"""Similarity join of word n-gram sets under Jaccard: light sets by fixed-size subsets, heavy sets by inverted lists.

Every set is put into one global order of shingles, rare ones first. If two sets reach the threshold, the first
``n - ceil(t * n) + c`` shingles of both share at least ``c`` of them. Light sets (up to a size chosen by cost) enumerate
the pairs (``c`` = 2) of that prefix as signatures; heavy sets are found by scanning the inverted lists of single
shingles (``c`` = 1), in which light sets near the boundary are listed, too. Any two sets that reach the threshold
meet in a list; nothing is capped. A pair is compared by whole sets only if short sketches do not rule it out: a set's sketch keeps, for
each of about ``n`` bits, whether an odd number of its shingles fall there, so two sketches differ in no more bits than their sets in
shingles.

Most lists are short, and most that are short bring unrelated sets together. Their pairs are written where the lists are gathered, without
those that positions and sizes rule out, and their entries go no further.

Long lists are not expanded into pairs. While they would give many pairs for their entries, each list compares its members with one
leader, and verified links make components; then the members of different components are paired, which loses no
component. While entries are gathered, lists of frequent shingles are salted by the shingle's count, so no task holds a whole one.

Equal sets are one node from the start. Shingles and sets are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.components import components
from strata.llm.memory import give_back
from strata.llm.scratch import stored
from strata.llm.tokens import slices
from strata.llm.word_hashes import mixed, words

NGRAM = 5
#: Jaccard of 80 / 100, in integers.
PERCENT = 80
#: Shingles whose counts are noted, most frequent first; bounds what every task holds.
NOTED = 1 << 18
#: Shingles that are counted together, and the count within them from which a shingle is reported.
BLOCK = 1 << 20
REPORTED = 3
#: Rows of one list that one task is meant to hold.
LIST_ROWS = 4096
#: Largest set that may count as light, and the cost of comparing two sets in list entries.
MOST_LIGHT = 512
COMPARE_COST = 50

#: Bits of the filter that keeps texts out of a shuffle.
FILTER_BITS = 1 << 24
#: Times that lists are compared with one leader each before what is left is paired (fewer if a turn does not halve
#: what is left), and pairs per entry that need no leader.
LEADER_TURNS = 6
PAIRS_PER_ROW = 0.6
#: Longest list that is paired where it is gathered.
SHORT_LIST = 16

_K = np.uint64(0x9E3779B97F4A7C15)
#: White space between words becomes a blank, A-Z become a-z.
_FOLD = bytes(0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Bytes of text that are cut into words together.
SLICE_BYTES = 1 << 20


def shingle_sets(texts: list[bytes | None], n: int = NGRAM) -> list[np.ndarray]:
    """Per text the sorted hashes of the distinct n-grams of its words; A-Z count as a-z. Fewer than ``n`` words are one
    n-gram; without words, or for null, the set is empty."""
    texts = [t or b"" for t in texts]
    starts, _, (h,) = words(b" ".join(texts).translate(_FOLD), b" ")
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    grams = np.full(max(0, len(h) - n + 1), n, dtype=np.uint64)
    for i in range(n):
        grams = mixed(grams * _K + h[i : i + len(grams)])
    out, at = [], 0
    for count in counts.tolist():
        if count >= n:
            out.append(np.unique(grams[at : at + count - n + 1]))
        elif count:
            whole = np.full(1, count, dtype=np.uint64)
            for i in range(at, at + count):
                whole = mixed(whole * _K + h[i : i + 1])
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
        at += count
    return out


def shingles(text: str | None, n: int = NGRAM) -> np.ndarray:
    """The set of one text."""
    return shingle_sets([(text or "").encode("utf-8", "replace")], n)[0]


def _parts(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the sets of their texts."""
    for whole in batches:
        for part in slices(whole, text, SLICE_BYTES):
            yield part, shingle_sets(part.column(text).cast(pa.large_binary()).to_pylist())
        pa.default_memory_pool().release_unused()
    give_back()


def fingerprint(found: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes()))))


def sketch(found: np.ndarray) -> np.ndarray | None:
    """Parities of the set's shingles by the low bits of their names, as 64-bit words: the power of two that
    gives each shingle a bit at least. Exclusive-or of its halves is the sketch of half the length."""
    if not len(found):
        return None
    bits = 64 << (-(-len(found) // 64) - 1).bit_length()
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def least_overlap(n: np.ndarray | int, percent: int = PERCENT):
    """Shingles that a set of size ``n`` shares at least with any partner."""
    return -(-n * percent // 100)


def _scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One pass: a row per document (``kind`` 0: id, size, node, sketch), per frequent shingle of a block (1: count, shingle), and per block
    (2: occurrences of other shingles and the sum of their squared counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def rows(kind: int, ids, a, b, bits=None) -> pa.RecordBatch:
            bits = [None] * len(a) if bits is None else bits
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(a), pa.int32()), pa.array(ids, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(bits, pa.list_(pa.int64()))],
                ["kind", "id", "a", "b", "sketch"])

        def counted() -> Iterator[pa.RecordBatch]:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= REPORTED
            rest = counts[~often].astype(np.int64)
            yield rows(1, [None] * int(often.sum()), counts[often].astype(np.int64), found[often].view(np.int64))
            yield rows(2, [None], [int(rest.sum())], [int((rest * rest).sum())])

        for batch, sets in _parts(batches, 1):
            yield rows(0, batch.column(0).to_pylist(), [len(s) for s in sets], [fingerprint(s) for s in sets], [sketch(s) for s in sets])
            for s in sets:
                held.append(s)
                size += len(s)
                if size >= BLOCK:
                    yield from counted()
                    held, size = [], 0
        if held:
            yield from counted()

    schema = "kind int, id bigint, a bigint, b bigint, sketch array<bigint>"
    return docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text")).mapInArrow(run, schema)


def light_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The largest light size with the least estimated cost, in list entries, over ``sizes`` (sets by size).

    A light set costs its pairs, a heavy one its entries and the comparisons that its lists bring up; light sets near
    the boundary cost their entries, too.
    """
    each = 1 + COMPARE_COST * max(0.0, list_length - 1)
    n = np.arange(MOST_LIGHT + 1)
    count = np.array([sizes.get(int(i), 0) for i in n], dtype=float)
    single = (n - least_overlap(n) + 1).astype(float)
    pairs = (single + 1) * single / 2
    heavy = np.cumsum((count * single * each)[::-1])[::-1]
    cost = []
    for x in n:
        near = (n <= x) & (100 * n >= PERCENT * x)
        cost.append((count * pairs)[: x + 1].sum() + (count * single)[near].sum() + (heavy[x + 1] if x < MOST_LIGHT else 0.0))
    return int(np.argmin(cost))


def _entries(docs: DataFrame, text: str, noted: np.ndarray, counts: np.ndarray, boundary: int) -> DataFrame:
    """List entries of every set: ``sig``, ``salt``, ``node``, ``n``, ``pos`` (in the set's order) and ``role`` (0: pair of a light set,
    1: heavy, 2: light near the boundary). Sets of a partition that are equal give theirs once."""
    near = -(-PERCENT * boundary // 100)
    shared = docs.sparkSession.sparkContext.broadcast((noted, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, count = shared.value
        seen: set[int] = set()
        out: list[list[np.ndarray]] = []
        held = 0

        def flushed() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["sig", "salt", "node", "n", "pos", "role"])

        def add(sig: np.ndarray, often_at: np.ndarray, pos: np.ndarray, node: int, n: int, role: int) -> None:
            salts = -(-often_at // LIST_ROWS)
            salt = np.where(salts > 1, (node & 0x7FFFFFFF) % np.maximum(salts, 1) + 1, 0)
            one = np.ones(len(sig), dtype=np.int64)
            out.append([sig.view(np.int64), salt.astype(np.int32), one * node, (one * n).astype(np.int32), pos.astype(np.int32), (one * role).astype(np.int32)])

        for _, sets in _parts(batches, 0):
            for found in sets:
                n = len(found)
                if n < 4:  # such sets reach the threshold with equal sets only
                    continue
                node = fingerprint(found)
                if node in seen:
                    continue
                seen.add(node)
                if len(seen) > 200_000:
                    seen.clear()
                at = np.minimum(np.searchsorted(often, found), max(len(often) - 1, 0))
                known = np.where(often[at] == found, count[at], 0) if len(often) else np.zeros(n, np.int64)
                order = np.argsort(known, kind="stable")  # by count, then by name: the set is sorted by name
                p = n - least_overlap(n) + 1
                if n > boundary or n >= near:
                    first = order[:p]
                    add(found[first], known[first], np.arange(p), node, n, 1 if n > boundary else 2)
                if n <= boundary:
                    first = order[: p + 1]
                    i, j = np.triu_indices(len(first), 1)
                    a, b = found[first[i]], found[first[j]]
                    add(mixed(mixed(a * _K) + b), np.minimum(known[first[i]], known[first[j]]), i, node, n, 0)
                held += len(out[-1][0])
                if held > 50_000:
                    yield flushed()
                    out, held = [], 0
        if out:
            yield flushed()

    schema = "sig bigint, salt int, node bigint, n int, pos int, role int"
    return docs.select(F.col(text).alias("_text")).mapInArrow(run, schema)


def _may_meet(a: Column, b: Column) -> Column:
    """Whether two entries of a list can be those of the first shared shingle of two sets that link."""
    na, nb, pa_, pb, ra, rb = (x[c] for c in ("n", "pos", "role") for x in (a, b))
    sizes = (100 * na >= PERCENT * nb) & (100 * nb >= PERCENT * na)
    after = F.least(na - pa_, nb - pb)
    reach = (100 + PERCENT) * after >= PERCENT * (na + nb)
    return sizes & reach & ((ra == 0) | (ra == 1) | (rb == 1)) & (a["node"] != b["node"])


def _may_link(a: str, b: str) -> Column:
    return _may_meet(F.col(a), F.col(b))


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(f"{a}.node", f"{b}.node").alias("a"), F.greatest(f"{a}.node", f"{b}.node").alias("b")).distinct()


def _near(pairs: DataFrame, scan: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose sketches differ in no more bits than sets that link may differ in shingles.

    Sizes of the sets of a pair are within the threshold, so one sketch is at most twice as long as the other.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("b")).distinct()
    known = scan.where("kind = 0").join(nodes, "b", "left_semi").groupBy("b").agg(F.first("a").alias("n"), F.first("sketch").alias("bits"))
    one, two = (known.select(F.col("b").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}")) for x in ("a", "b"))

    def folded(bits: str, other: str) -> Column:
        half = F.floor(F.size(bits) / 2).cast("int")
        halves = F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) > F.size(other), halves).otherwise(F.col(bits))

    apart = F.zip_with(folded("bitsa", "bitsb"), folded("bitsb", "bitsa"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(apart, F.lit(0), lambda total, x: total + x)
    may = (100 - PERCENT) * (F.col("na") + F.col("nb")) >= (100 + PERCENT) * differ
    return pairs.join(one, "a").join(two, "b").where(may).select("a", "b")


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of every id, in a table of fixed size, put together on the cluster."""
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = ids.select(F.floor(bit / 32).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(32)).cast("int")).alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 32, np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table


def _sets(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``node`` and its sorted ``set`` for the nodes of ``wanted`` (``id``, ``node``).

    A filter of fixed size keeps most other texts out of the shuffle; the join then decides.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(wanted))
    some = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("_text")).withColumn("_bit", F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            bit = whole.column(2).to_numpy()
            passed = (bits.value[bit // 32] >> (bit % 32)) & 1
            yield whole.filter(pa.array(passed.astype(bool))).select(["id", "_text"])

    # The shuffle parts the two steps in Python: in one stage they would take two workers for each core.
    found = some.mapInArrow(sift, "id bigint, _text string").join(wanted.hint("merge"), "id").select("node", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _parts(batches, 1):
            keep = [i for i, (s, k) in enumerate(zip(sets, batch.column(0).to_pylist(), strict=True)) if fingerprint(s) == k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array([sets[i].view(np.int64) for i in keep], pa.list_(pa.int64()))],
                ["node", "set"])

    return found.mapInArrow(run, "node bigint, set array<bigint>")


class _Linker:
    """Compares pairs of nodes that their sketches do not rule out by their whole sets, which are read from the texts when first needed."""

    def __init__(self, docs: DataFrame, key: str, text: str, scan: DataFrame, reps: DataFrame):
        self.docs, self.key, self.text, self.scan, self.reps = docs, key, text, scan, reps
        self.sets: DataFrame | None = None
        self.links: DataFrame | None = None

    def add(self, pairs: DataFrame) -> DataFrame:
        """Adds those of ``pairs`` that reach the threshold to the links; returns the components so far. Of the sets read before, those
        that these pairs name travel."""
        pairs = stored(_near(stored(pairs, "ngram-pairs"), self.scan), "ngram-near")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        new = nodes if self.sets is None else nodes.join(self.sets, "node", "left_anti")
        wanted = stored(new.join(self.reps, "node").select("id", "node"), "ngram-wanted")
        if self.sets is None or not wanted.isEmpty():
            more = stored(_sets(self.docs, self.key, self.text, wanted), "ngram-sets")
            self.sets = more if self.sets is None else self.sets.union(more)
        one = self.sets.select(F.col("node").alias("a"), F.col("set").alias("sa")).join(pairs.select("a"), "a", "left_semi")
        two = self.sets.select(F.col("node").alias("b"), F.col("set").alias("sb")).join(pairs.select("b"), "b", "left_semi")
        common = F.size(F.array_intersect("sa", "sb"))
        enough = 100 * common >= PERCENT * (F.size("sa") + F.size("sb") - common)
        found = stored(pairs.join(one, "a").join(two, "b").where(enough).select("a", "b"), "ngram-links")
        self.links = found if self.links is None else self.links.union(found)
        return components(self.links)


def _lists(docs: DataFrame, key: str, text: str, scan: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of the long lists: ``sig`` and ``e``, with the number of a node's entries as its weight; and the pairs of the short ones."""
    often = scan.where("kind = 1").groupBy(F.col("b").alias("sig")).agg(F.sum("a").alias("count"))
    often = often.orderBy(F.desc("count"), "sig").limit(NOTED).toArrow()
    noted, counts = often.column("sig").to_numpy().view(np.uint64), often.column("count").to_numpy()
    by_name = np.argsort(noted)
    single, squares = scan.where("kind = 2").agg(F.sum("a"), F.sum("b")).first()
    sizes = {r["n"]: r["count"] for r in reps.where(F.col("n") <= MOST_LIGHT).groupBy("n").count().collect()}
    boundary = light_boundary(sizes, squares / single if single else 1.0)
    lists = _entries(docs.where(F.col(key).isNotNull()), text, noted[by_name], counts[by_name], boundary)
    one_list = Window.partitionBy("sig", "salt")
    spread = lists.withColumn("lo", F.min("node").over(one_list)).withColumn("hi", F.max("node").over(one_list))
    shared = spread.where("lo <> hi OR salt > 0").drop("lo", "hi").distinct().withColumn("size", F.count(F.lit(1)).over(one_list))
    short = (F.col("salt") == 0) & (F.col("size") <= SHORT_LIST)
    x = F.struct("node", "n", "pos", "role")
    rest = one_list.orderBy("node", "pos", "role", "n").rowsBetween(1, max(1, SHORT_LIST - 1))
    paired = shared.withColumn("x", x).withColumn("after", F.collect_list(F.when(short, x)).over(rest))
    paired = paired.withColumn("ys", F.filter("after", lambda y: _may_meet(F.col("x"), y)))
    kept = stored(paired.where(~short | (F.size("ys") > 0)).select("sig", "x", short.alias("short"), "ys"), "ngram-shared")
    pairs = _pairs(kept.where("short").select("x", F.explode("ys").alias("y")), "x", "y")
    long = kept.where("NOT short").select("sig", "x.*")
    weight = long.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
    entry = F.struct("node", "n", "pos", "role", "weight").alias("e")
    return stored(long.join(weight, "node").select("sig", entry), "ngram-lists"), pairs


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_shingles`` and ``component_id``, the smallest key that links lead to, its own included.

    Rows with a null key have a null component. Null texts and texts without words have an empty set and link with nothing.
    Rows that repeat a key belong to one component only through their texts' links. An empty table gives an empty result.
    """
    return _members(docs, key, text).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def _members(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n``, the ``node`` of its set, the ``component`` of that and the component's name ``component_id``."""
    scan = stored(_scan(docs, key, text), "ngram-scan")
    nodes = scan.where("kind = 0").select("id", F.col("a").alias("n"), F.col("b").alias("node"))
    reps = nodes.where("n > 0 AND id IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    lists, short = _lists(docs, key, text, scan, reps)
    linker = _Linker(docs, key, text, scan, reps)
    joined = lists.select(F.col("e.node").alias("node"), F.col("e.node").alias("component")).where("false")
    rest = lists.withColumn("c", F.col("e.node"))
    before = None

    def added(pairs: DataFrame) -> DataFrame:
        """The pairs of the short lists go with the first others."""
        nonlocal short
        pairs, short = pairs if short is None else pairs.union(short).distinct(), None
        return linker.add(pairs)

    for turn in range(LEADER_TURNS + 1):
        spread = rest.groupBy("sig", "c").count().groupBy("sig").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("q"))
        rows, pairs = spread.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("q")) / 2)).first()
        if not pairs:
            break
        helped = before is None or pairs <= before / 2
        before = pairs
        if turn == LEADER_TURNS or pairs <= PAIRS_PER_ROW * rows or not helped:
            found = rest.alias("x").join(rest.alias("y"), "sig").where(F.expr("x.c < y.c") & _may_link("x.e", "y.e"))
            joined = added(_pairs(found, "x.e", "y.e"))
            break
        # In each list the heaviest node leads first, as it shares most with the others; later a random one.
        rank = F.col("e.weight") if turn == 0 else F.xxhash64(F.lit(turn), "e.node")
        order = F.struct((F.col("e.role") == 1).alias("heavy"), rank.alias("rank"), "e", "c")
        leaders = rest.groupBy("sig").agg(F.max(order).alias("m")).select("sig", F.col("m.e").alias("l"), F.col("m.c").alias("lc"))
        joined = added(_pairs(rest.join(leaders, "sig").where((F.col("c") != F.col("lc")) & _may_link("e", "l")), "e", "l"))
        named = lists.join(joined, F.col("e.node") == F.col("node"), "left").select("sig", "e", F.coalesce("component", "e.node").alias("c"))
        mixed = named.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("sig")
        rest = stored(named.join(mixed, "sig"), "ngram-rest")
    if short is not None:
        joined = linker.add(short)

    # The name of a component is its smallest document id.
    member = reps.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = member.groupBy("component").agg(F.min("id").alias("component_id"))
    by_node = member.join(names, "component").select("node", "component", "component_id")
    ids = nodes.where("id IS NOT NULL AND n > 0").join(by_node, "node").select("id", "n", "node", "component", "component_id")
    bare = nodes.where("id IS NULL OR n = 0").select("id", "n", "node", F.col("node").alias("component"), F.col("id").alias("component_id"))
    return ids.union(bare)


def _with_node(held: DataFrame) -> DataFrame:
    """``held`` (``_id``, ``_text``, ``_row``) with the ``_node`` of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _parts(batches, 1):
            found = pa.array([fingerprint(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "_node"])

    return held.mapInArrow(run, StructType([*held.schema.fields, StructField("_node", LongType())]))


def _sifted(held: DataFrame, counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``held`` that certainly stay, and those on which a join with ``counted`` (``_id``, ``_rows``, ``_named``) has to decide.

    Two filters of fixed size, of the ids that stay and of all that need not stay with every row, are sent to every task. Only rows whose
    bit is in both are unsure; a row in the second alone goes. So texts need no shuffle, but for ids that repeat and chance hits, which grow
    with the number of ids.
    """
    bit = F.pmod(F.xxhash64(F.col("_id").cast("bigint")), F.lit(FILTER_BITS))
    word, place = F.shiftright(bit, 6), F.pmod(bit, F.lit(64)).cast("int")
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    whole = (F.col("_rows") == 1) & (F.col("_named") > 0)
    words = counted.groupBy(word.alias("_word")).agg(
        *[F.coalesce(F.bit_or(F.when(which, mark)), F.lit(0).cast("bigint")).alias(name) for name, which in (("_some", F.col("_named") > 0), ("_not_all", ~whole))])
    known = held.withColumn("_word", word).join(F.broadcast(words), "_word", "left")
    some, not_all = (F.coalesce(F.bit_get(c, place), F.lit(0)) == 1 for c in ("_some", "_not_all"))
    return known.where(F.col("_id").isNull() | ~not_all).select(*held.columns), known.where(some & not_all).select(*held.columns)


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the document with its smallest key.

    Of rows that repeat a kept key one stays per component that the key names: unlinked texts of one key all stay, and a
    copy of a smaller key's text does not. Rows with a null key cannot be named and stay. The columns are those of ``docs``.
    """
    found = _members(docs, key, text).where("id IS NOT NULL")
    named = F.col("id") == F.col("component_id")
    counted = found.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(named).alias("_named"))
    counted = stored(counted, "ngram-kept")
    held = docs.select(
        F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    stay, unsure = _sifted(held, counted)
    kept = counted.where("_named > 0").drop("_named")
    stay = stay.unionByName(unsure.join(kept.where("_rows = 1"), "_id", "left_semi")).select("_row")
    again = kept.where("_rows > 1")
    if not again.isEmpty():
        nodes = found.where(named).withColumnRenamed("id", "_id").join(again, "_id", "left_semi").groupBy("_id", "component").agg(F.min("node").alias("_node"))
        rows = _with_node(unsure.join(again, "_id", "left_semi"))
        stay = stay.unionByName(rows.join(nodes, ["_id", "_node"], "left_semi").dropDuplicates(["_id", "_node"]).select("_row"))
    return stay.select("_row.*")
