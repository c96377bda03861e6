"""Ranked lexical search in reverse: documents are streamed through an inverted index of the queries.

The items (queries) are few and known beforehand, so their terms make a small inverted index, which is broadcast.
One pass over the whole texts writes every document's length and its counts of indexed terms; document frequencies,
the number of documents and their total length come from that table. A second pass over it, not over the texts, scores
each document for all items that share a term with it and updates one bounded heap per item and task. The heaps of
the tasks are merged in two steps, so no task sees more than a bounded number of entries per item and salt.

An index holds at most ``BLOCK_ITEMS`` items and about ``BLOCK_BYTES`` of their texts (an item is never cut); more items
are worked off in further blocks, each with its own pass. Nothing is pruned: every document is scored for every item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.scratch import stored
from strata.llm.tokens import slices

#: Bounds of one broadcast index.
BLOCK_ITEMS = 4096
BLOCK_BYTES = 4 << 20
#: Bytes of text, and documents, that a task handles at a time.
SLICE_BYTES = 4 << 20
SLICE_DOCS = 512
#: Tasks' heaps of an item that are merged together first.
SALTS = 64

#: Factors of the score, in hundredths and thousandths. Fixed values.
LENGTH_SHARE, SATURATION, SCALE = 90, 8, 1_000_000_000


def _folded(byte: int) -> int:
    if byte <= 0x2F or 0x3A <= byte <= 0x40 or 0x5B <= byte <= 0x60 or 0x7B <= byte <= 0x7F:
        return 0x20
    return byte + 32 if 0x41 <= byte <= 0x5A else byte


_FOLD = bytes(map(_folded, range(256)))


def terms(text: bytes | str | None) -> list[bytes]:
    """The terms of a whole text in order, with repeats: runs of ASCII letters and digits and of all characters
    beyond ASCII; A-Z count as a-z. Null has none."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return raw.translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def counted(docs: DataFrame, index: dict[bytes, int], key: str, text: str) -> DataFrame:
    """``_key``, ``n`` (all terms of the text), ``terms`` and ``counts`` (those in ``index``) of documents with a term."""
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                rows, lengths, at, found, often = [], [], [0], [], []
                for i, raw in enumerate(part.column(1).cast(pa.large_binary())):
                    words = terms(raw.as_py())
                    if not words:
                        continue
                    counts = Counter(words)
                    rows.append(i)
                    lengths.append(len(words))
                    for term in counts.keys() & places.keys():
                        found.append(places[term])
                        often.append(counts[term])
                    at.append(len(found))
                offsets = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64()))],
                    ["_key", "n", "terms", "counts"])
                pa.default_memory_pool().release_unused()

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(
        run, f"_key {kind}, n bigint, terms array<int>, counts array<bigint>")


def saturated(often: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Scaled term frequency of each count in a document of ``n`` terms; whole numbers throughout."""
    if len(n) and LENGTH_SHARE * int(n.max()) * documents >= 1 << 62:
        n = n.astype(object)
    norm = (100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // total).astype(np.int64)
    return (SCALE * often) // (1000 * often + SATURATION * norm)


class _Heaps:
    """The best entries of each item, at most ``top``: a higher score first, then a smaller key, null keys last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.held: list[list[tuple[int, int]]] = [[] for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)

    def update(self, scores: np.ndarray, keys: list) -> None:
        """``scores`` of items (rows) for documents (columns); scores of 0 count as no match."""
        bound = self.least
        if scores.shape[1] > self.top:
            bound = np.maximum(bound, np.partition(scores, -self.top, axis=1)[:, -self.top])
        for item, doc in np.argwhere(scores >= bound[:, None]).tolist():
            heap = self.held[item]
            entry = (int(scores[item, doc]), -(1 << 64) if keys[doc] is None else -keys[doc])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[item] = heap[0][0]


def scored(matches: DataFrame, postings: list[np.ndarray], weights: np.ndarray, documents: int, total: int, items: int, top: int) -> DataFrame:
    """``place``, ``_key``, ``score``: the heaps of every task over rows of :func:`counted`."""
    shared = matches.sparkSession.sparkContext.broadcast((postings, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, factor = shared.value
        heaps = _Heaps(items, top)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_DOCS):
                part = whole.slice(start, SLICE_DOCS)
                size = part.column(2).value_lengths().to_numpy()
                doc = np.repeat(np.arange(part.num_rows), size)
                term = part.column(2).flatten().to_numpy()
                share = saturated(part.column(3).flatten().to_numpy(), part.column(1).to_numpy()[doc], documents, total)
                order = np.argsort(term, kind="stable")
                scores = np.zeros((items, part.num_rows), dtype=np.int64)
                for run_of in np.split(order, np.flatnonzero(np.diff(term[order])) + 1) if len(order) else []:
                    t = term[run_of[0]]
                    scores[lists[t][:, None], doc[run_of]] += factor[t] * share[run_of]
                heaps.update(scores, part.column(0).to_pylist())
        rows = [(place, score, other) for place, heap in enumerate(heaps.held) for score, other in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([None if r[2] == -(1 << 64) else -r[2] for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.int64())], ["place", "_key", "score"])

    return matches.select(F.col("_key").cast("bigint"), "n", "terms", "counts").mapInArrow(run, "place int, _key bigint, score bigint")


def best(rows: DataFrame, group: list[str], top: int, rank: str) -> DataFrame:
    """The first ``top`` rows of each group, numbered from 1: highest score, then smallest key, nulls last."""
    order = [F.col("score").desc(), F.col("_key").asc_nulls_last()]
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= top)


def _block(spark, docs: DataFrame, items: pa.Table, key: str, text: str, top: int) -> DataFrame | None:
    """Ranks of one block of items (``item``, ``query``, sorted), by their place in it; None if no item can match."""
    index: dict[bytes, int] = {}
    postings: list[list[int]] = []
    for place, query in enumerate(items.column(1).to_pylist()):
        for term in sorted(set(terms(query))):
            if index.setdefault(term, len(postings)) == len(postings):
                postings.append([])
            postings[index[term]].append(place)
    if not postings:
        return None
    matches = stored(counted(docs, index, key, text), "search-counts")
    documents, total = matches.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    held = matches.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()  # a row per indexed term at most
    weights = np.zeros(len(postings), dtype=np.int64)
    for term, count in zip(held.column(0).to_pylist(), held.column(1).to_pylist(), strict=True):
        weights[term] = weight(documents, count)
    heaps = scored(matches, [np.array(p) for p in postings], weights, documents, total, items.num_rows, top)
    salt = F.pmod(F.xxhash64("_key"), F.lit(SALTS))
    return best(best(heaps.withColumn("_salt", salt), ["place", "_salt"], top, "_first"), ["place"], top, "rank").drop("_first", "_salt")


def search(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", query: str = "text", top: int = 10,
) -> DataFrame:
    """``item``, ``rank`` (from 1), ``key``, ``score``: the ``top`` documents with a score above 0 of every item.

    ``key`` is integral; equal scores rank by ascending key, null keys last. Rows of ``docs`` that repeat a key rank each on its
    own. Null, empty and term-less texts match nothing and do not count as documents. Equal rows of ``items`` are
    answered once; an id with several texts has one ranking per text. Items without a term, or whose terms no
    document holds, have no rows, and an empty table of either kind gives none. Other columns of the inputs are not
    looked at.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{query}`").alias("query")).distinct()
    count, size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("query"))).first()
    blocks = max(1, -(-count // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    if blocks > 1:
        blocks *= 2  # blocks are dealt by a hash, so some hold more than their part
    kind = asked.schema["item"].dataType.simpleString()
    out = spark.createDataFrame([], f"item {kind}, rank int, _key bigint, score bigint")
    for b in range(blocks):
        dealt = F.pmod(F.xxhash64("item", "query"), F.lit(blocks)) == b
        block = asked.where(dealt).toArrow().sort_by([("item", "ascending"), ("query", "ascending")])
        found = _block(spark, docs, block, key, text, top)
        if found is not None:
            names = spark.createDataFrame(pa.table({"place": pa.array(range(block.num_rows), pa.int32()), "item": block.column("item")}))
            out = out.unionByName(found.join(names, "place").select("item", "rank", "_key", "score"))
    return out.select(F.col("item").alias(item), "rank", F.col("_key").alias(key), "score")
