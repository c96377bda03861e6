"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts in a second pass.

N-grams are named by hashes, whose first bits deal them to hash partitions. Tasks sum the n-grams of large
blocks and send one summary per block and partition, sorted and compressed, to the partition's task, which merges them with a bounded number
of counters: when there are more, the next smaller count is taken off all of them. The capacity is ``SLACK`` times the
partition's mass divided by the threshold, so counts are too low by less than the threshold at any time (a summary
grows rather than let its error reach it), and every n-gram that reaches the threshold survives. Survivors set the bits of
their partition's part of a filter of bounded size. Phrases of three and four words are summarised in a scan of
their own, in which only those are counted whose pairs of neighbours all passed the filter.

The last scan counts the n-grams that pass the filters exactly, by their words and not by their hashes; tasks sum what they meet
before they send it, compressed, to the hash partitions. What a filter lets
through in error, be it by chance or because a large corpus fills it, is counted as well and then falls below the threshold, so
filters and hashes cost time but change no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.memory import give_back
from strata.llm.scratch import stored
from strata.llm.tokens import slices
from strata.llm.word_hashes import BASES, mixed, words

#: Words in a phrase, at most.
LONGEST = 4
#: Counters of a summary per n-gram of the threshold's mass, and those that it has in any case.
SLACK = 8
LEAST_COUNTERS = 1 << 16
#: N-grams that a hash partition is meant to see, and that a task sums before it sends them on.
PARTITION_MASS = 1 << 23
BLOCK_MASS = 1 << 22
#: Bits of one filter, all partitions together, and of one partition, at most.
FILTER_BITS = 1 << 28
PART_BITS = 1 << 21
#: Bytes of text that are cut into words together, rows of phrases that are summed together, and phrases that a task then holds.
SLICE_BYTES = 2 << 20
SUMMED_PHRASES = 600_000
HELD_PHRASES = 400_000
#: Rows that one window of a language is meant to sort.
WINDOW_ROWS = 50_000
#: What stands for a missing language. Fixed value.
NO_LANGUAGE = "und"

_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_END, _GAP = 0x0A, 0x20
_FOLD = bytes(_END if b in _PIECE_ENDS else _GAP if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bits of an n-gram's name within its partition, and odd numbers that spread it over a filter. Fixed values.
NAME_BITS = 32
_SPREAD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


class Words:
    """The words of some texts of one language: where they lie, which piece they are in, and their hashes."""

    def __init__(self, texts: list[bytes], lang: str, hashes: int = 1):
        self.buffer = b"\n".join(texts).translate(_FOLD) + b"\n"
        self.starts, self.ends, self.hashes = words(self.buffer, bytes([_GAP, _END]), hashes)
        self.piece = np.searchsorted(np.flatnonzero(np.frombuffer(self.buffer, dtype=np.uint8) == _END), self.starts)
        self.seed = _seed(lang)

    def __len__(self) -> int:
        return len(self.starts)

    def whole(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each place on lie in one piece."""
        return self.piece[: len(self) - n + 1] == self.piece[n - 1 :]

    def grams(self, n: int, which: int = 0) -> np.ndarray:
        """Hashes of the ``n`` words from each place on."""
        own, count = self.hashes[which], max(0, len(self) - n + 1)
        out = np.full(count, (self.seed + n) % (1 << 64), dtype=np.uint64)
        for i in range(n):
            out = mixed(out * _STEP + own[i : i + count])
        return out

    def phrase(self, at: int, n: int) -> bytes:
        """The words from ``at`` on, with one blank between."""
        if n == 1:
            return self.buffer[self.starts[at] : self.ends[at]]
        return b" ".join([self.buffer[self.starts[i] : self.ends[i]] for i in range(at, at + n)])


def _seed(lang: str) -> int:
    value = 0
    for byte in lang.encode("utf-8", "replace"):
        value = (value * BASES[0] + byte + 1) % (1 << 64)
    return value


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a batch (language, text) by language; null texts are left out, as they have no words."""
    langs = pc.fill_null(batch.column(0).cast(pa.large_string()), NO_LANGUAGE).dictionary_encode()
    code = langs.indices.to_numpy()
    texts = batch.column(1).cast(pa.large_binary())
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        part = texts.filter(pa.array(code == i))
        yield lang, part.drop_null().to_pylist()


def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """The hash partition of each n-gram: the first bits of its hash."""
    return grams >> np.uint64(64 - (parts.bit_length() - 1))


def name_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """The bits after those of the partition; sorted hashes have sorted names within a partition."""
    return (grams >> np.uint64(64 - (parts.bit_length() - 1) - NAME_BITS)) & np.uint64((1 << NAME_BITS) - 1)


def packed(names: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted names and their counts in few bytes: differences, by place of their bytes, compressed."""
    both = np.concatenate([np.diff(names, prepend=names.dtype.type(0)).astype("<u4"), counts.astype("<u4")])
    return pa.Codec("zstd", 1).compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def unpacked(blob: pa.Buffer | bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob, 8 * n, asbytes=True), dtype=np.uint8)
    both = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(both[:n].astype(np.uint64), dtype=np.uint64), both[n:].astype(np.int64)


class Filter:
    """Bits of a set of n-grams: per hash partition the same number, three of them for each n-gram."""

    def __init__(self, parts: int, bits: int):
        self.parts, self.bits = parts, bits
        self.held = np.zeros(parts * bits // 8, dtype=np.uint8)

    @staticmethod
    def places(names: np.ndarray, bits: int) -> list[np.ndarray]:
        return [((names * np.uint64(odd)) >> np.uint64(24)) & np.uint64(bits - 1) for odd in _SPREAD]

    @staticmethod
    def part(names: np.ndarray, bits: int) -> bytes:
        """One partition's bits with those of the n-grams set."""
        out = np.zeros(bits, dtype=bool)
        for place in Filter.places(names, bits):
            out[place] = True
        return np.packbits(out, bitorder="little").tobytes()

    def fill(self, part: int, found: pa.Buffer | bytes) -> None:
        size = self.bits // 8
        self.held[part * size : (part + 1) * size] = np.frombuffer(found, dtype=np.uint8)

    def passes(self, grams: np.ndarray) -> np.ndarray:
        base = part_of(grams, self.parts) * np.uint64(self.bits)
        out = np.ones(len(grams), dtype=bool)
        for place in self.places(name_of(grams, self.parts), self.bits):
            at = base + place
            out &= (self.held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def summed(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names sorted and without repeats, with the sums of their counts."""
    order = np.argsort(names, kind="stable")
    names, counts = names[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.empty(0, np.int64)
    return names[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary that grows with its mass: counts are at most ``error`` too low, and ``error`` stays below
    the threshold, so what occurred ``least`` times is never lost. Its counters exceed the mass divided by the threshold ``slack`` times at
    least, and up to eight times as often when the mass has grown a thousandfold since it was first full."""

    def __init__(self, least: int, slack: int = SLACK, counters: int = LEAST_COUNTERS):
        self.least, self.slack, self.counters = least, slack, counters
        self.names, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.mass = self.error = self.waiting = 0
        self.more: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, names: np.ndarray, counts: np.ndarray) -> None:
        self.more.append((names, counts))
        self.mass += int(counts.sum())
        self.waiting += len(names)
        if self.waiting > max(self.counters, len(self.names)):
            self.merge()

    def merge(self) -> None:
        names, counts = (np.concatenate([held, *(m[i] for m in self.more)]) for i, held in ((0, self.names), (1, self.counts)))
        self.more, self.waiting = [], 0
        names, counts = summed(names, counts)
        # With each quarter of the error that is used up, the rest is spent half as fast.
        slack = self.slack << (4 * self.error // self.least)
        capacity = max(self.counters, slack * self.mass // self.least + 1)
        if len(names) > capacity:
            off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            if self.error + off < self.least:
                stays = counts > off
                names, counts, self.error = names[stays], counts[stays] - off, self.error + off
        self.names, self.counts = names, counts

    def survivors(self) -> np.ndarray:
        """Names that may have occurred ``least`` times; none that did is missing."""
        self.merge()
        return self.names[self.counts + self.error >= self.least]


def summaries(docs: DataFrame, lengths: tuple[int, ...], parts: int, pairs: Filter | None) -> DataFrame:
    """Counts of the n-grams of ``docs`` (language, text) in blocks: a row per block and hash partition.

    With ``pairs``, only n-grams whose pairs of neighbours all pass it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pairs) if pairs is not None else None

    def found(text: Words) -> Iterator[np.ndarray]:
        passed = shared.value.passes(text.grams(2)) if shared is not None and len(text) > 1 else None
        for n in lengths:
            if len(text) < n:
                continue
            fits = text.whole(n)
            if passed is not None:
                for i in range(n - 1):
                    fits &= passed[i : i + len(fits)]
            yield text.grams(n)[fits]

    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        names, counts = np.unique(np.concatenate(held), return_counts=True)
        ends = np.searchsorted(part_of(names, parts), np.arange(parts + 1))
        full = np.flatnonzero(ends[1:] > ends[:-1])
        names = name_of(names, parts)
        blobs = [packed(names[ends[p] : ends[p + 1]], counts[ends[p] : ends[p + 1]]) for p in full]
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array(ends[full + 1] - ends[full], pa.int32()), pa.array(blobs, pa.binary())], ["part", "n", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                for lang, texts in by_language(part):
                    for names in found(Words(texts, lang)) if texts else ():
                        held.append(names)
                        size += len(names)
                if size >= BLOCK_MASS:
                    yield rows(held)
                    held, size = [], 0
                pa.default_memory_pool().release_unused()
        if size:
            yield rows(held)
        give_back()

    return docs.mapInArrow(run, "part int, n int, blob binary")


def survivors(counted: DataFrame, parts: int, bits: int, least: int) -> Filter:
    """Merge the rows of :func:`summaries` by hash partition; the filter of what may reach ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, summary = None, None

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([own], pa.int32()), pa.array([Filter.part(summary.survivors(), bits)], pa.binary())], ["part", "bits"])

        for batch in batches:
            for part, n, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
                if part.as_py() != own:
                    if summary is not None:
                        yield ended()
                    own, summary = part.as_py(), Summary(least)
                summary.add(*unpacked(blob.as_buffer(), n.as_py()))
            pa.default_memory_pool().release_unused()
        if summary is not None:
            yield ended()

    merged = counted.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, "part int, bits binary")
    found = merged.toArrow()  # at most FILTER_BITS in all
    out = Filter(parts, bits)
    for part, set_bits in zip(found.column(0).to_pylist(), found.column(1), strict=True):
        out.fill(part, set_bits.as_buffer())
    return out


_PHRASES = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.binary()), ("f", pa.int64())])


def summed_phrases(held: list[pa.Table]) -> pa.Table:
    """One row per part, language and phrase."""
    if not held:
        return _PHRASES.empty_table()
    both = pa.concat_tables(held).group_by(["part", "lang", "words", "phrase"], use_threads=False).aggregate([("f", "sum")])
    return both.rename_columns(["part", "lang", "words", "phrase", "f"]).select(_PHRASES.names)


def exact(docs: DataFrame, longest: int, parts: int, short: Filter, long: Filter | None) -> DataFrame:
    """Phrases of ``docs`` that pass a filter, with their counts in a task's part of the texts: a row per task and hash partition,
    compressed. A phrase of no words counts all words of its language.

    The first filter is asked for one and two words, the second for more.
    """
    shared = docs.sparkSession.sparkContext.broadcast((short, long))

    def rows(held: pa.Table) -> pa.RecordBatch:
        packing = pa.ipc.IpcWriteOptions(compression="zstd")
        held = held.sort_by([("part", "ascending"), ("words", "ascending"), ("phrase", "ascending")]).combine_chunks()
        part = held.column("part").to_numpy()
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        blobs = []
        for at, end in zip(starts, [*starts[1:], len(part)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _PHRASES, options=packing) as out:
                out.write_table(held.slice(at, end - at))
            blobs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(part[starts], pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    def counted(text: Words, lang: str) -> Iterator[pa.Table]:
        yield pa.Table.from_pydict({"part": [0], "lang": [lang], "words": [0], "phrase": [b""], "f": [len(text)]}, _PHRASES)
        passed = None
        for n in range(1, min(longest, len(text)) + 1):
            names = text.grams(n)
            fits = text.whole(n)
            if n <= 2:
                fits &= shared.value[0].passes(names)
                passed = fits
            else:
                for i in range(n - 1):
                    fits &= passed[i : i + len(fits)]
                fits[fits] = shared.value[1].passes(names[fits])
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            # Equal n-grams are neighbours by the first hash; a second one, of another base, tells apart those that share it.
            again = text.grams(n, 1)[at]
            order = np.argsort(names[at], kind="stable")
            one, two = names[at][order], again[order]
            first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
            phrases = [text.phrase(i, n) for i in at[order[first]].tolist()]
            yield pa.Table.from_arrays(
                [pa.array(part_of(one[first], parts).astype(np.int32)), pa.array([lang] * len(first), pa.string()), pa.array(np.full(len(first), n, np.int32)),
                 pa.array(phrases, pa.binary()), pa.array(np.diff(np.append(first, len(order))), pa.int64())], schema=_PHRASES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                for lang, texts in by_language(part):
                    for found in counted(Words(texts, lang, 2), lang) if texts else ():
                        held.append(found)
                        size += len(found)
                if size >= SUMMED_PHRASES:
                    held = [summed_phrases(held)]
                    size = len(held[0])
                    if size >= HELD_PHRASES:
                        yield rows(held[0])
                        held, size = [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield rows(summed_phrases(held))
        give_back()

    return docs.mapInArrow(run, "part int, blob binary")


def merged_phrases(counted: DataFrame, parts: int, least: int) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``f`` of all rows of :func:`exact` together, of phrases that occur ``least`` times and of no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = None, [], 0

        def ended() -> Iterator[pa.RecordBatch]:
            found = summed_phrases(held)
            often = pc.or_(pc.greater_equal(found.column("f"), least), pc.equal(found.column("words"), 0))
            found = found.filter(often).drop_columns(["part"])
            yield from found.set_column(2, "phrase", found.column("phrase").cast(pa.string())).combine_chunks().to_batches()

        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if part != own:
                    if held:
                        yield from ended()
                    own, held, size = part, [], 0
                held.append(pa.ipc.open_stream(blob.as_buffer()).read_all())
                size += len(held[-1])
                if size >= 2 * SUMMED_PHRASES:
                    # What stays is what the partition holds: its phrases that passed a filter.
                    held = [summed_phrases(held)]
                    size = 0
            pa.default_memory_pool().release_unused()
        if held:
            yield from ended()

    dealt = counted.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "lang string, words int, phrase string, f bigint")


def frequent(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, longest: int = LONGEST) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``f``: exact counts of all phrases of up to ``longest`` words that occur ``least`` times
    at least in texts of a language, and per language all words as the row with ``words`` 0."""
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 16
    while parts * PARTITION_MASS < size // 3:  # about six bytes a word, and two n-grams of it in a scan
        parts *= 2
    bits = min(PART_BITS, max(64, 1 << ((FILTER_BITS // parts).bit_length() - 1)))
    short = survivors(summaries(rows, (1, 2), parts, None), parts, bits, least)
    lengths = tuple(range(3, longest + 1))
    long = survivors(summaries(rows, lengths, parts, short), parts, bits, least) if lengths else None
    return stored(merged_phrases(exact(rows, longest, parts, short, long), parts, least), "phrases")


def _split(phrase: str) -> Column:
    return F.split(phrase, " ")


def _join(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(counts: DataFrame) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``a``, ``l``, ``r``, ``score`` of phrases of two words and more, by their lowest-scoring cut (ties: the first)."""
    phrases = counts.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    each = _split("phrase")
    cuts = phrases.withColumn("_left", _join(each, F.lit(1), F.col("k"))).withColumn("_right", _join(each, F.col("k") + 1, F.col("words") - F.col("k")))
    own = counts.where("words > 0")
    left = own.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = own.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    wide = "decimal(38,0)"
    score = F.expr(f"CAST(2000000 AS {wide}) * CAST(a AS decimal(30,0)) div (CAST(l AS {wide}) + CAST(r AS {wide}))")
    lowest = F.min(F.struct(score.cast("bigint").alias("score"), "k", "l", "r"))
    least = both.groupBy("lang", "words", "phrase", "a").agg(lowest.alias("c"))
    return least.select("lang", "words", "phrase", "a", "c.l", "c.r", "c.score")


def covered(counts: DataFrame, percent: int) -> DataFrame:
    """``lang``, ``phrase`` of those whose words lie together in a longer phrase that occurs ``percent`` of a hundred times as often."""
    longer = counts.where("words > 2").select("lang", "words", "phrase", F.col("f").alias("b"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _join(_split("phrase"), i, n))))
    inside = longer.select("lang", "b", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    whole = counts.where("words > 1").select("lang", "phrase", F.col("f").alias("a")).join(inside, ["lang", "phrase"])
    wide = "decimal(38,0)"
    return whole.where(100 * F.col("b").cast(wide) >= percent * F.col("a").cast(wide)).select("lang", "phrase")


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, longest: int = LONGEST, percent: int = 80, top: int = 2000,
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts have A-Z lower-cased and are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at blanks and
    tabs; a phrase does not leave its piece. Null and empty texts have no words, a null language is ``und``, and
    languages are apart. Rows count as often as they are there. Equal scores go by count, then by phrase in byte order. An empty
    table, and one without a phrase that reaches ``least``, gives no rows. Other columns of ``docs`` are not looked at.
    """
    counts = frequent(docs, text=text, lang=lang, least=least, longest=longest)
    found = scored(counts).join(covered(counts, percent), ["lang", "phrase"], "left_anti")
    found = stored(found, "collocations")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salts = max(1, -(-found.count() // WINDOW_ROWS))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    first = salted.withColumn("_first", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_first") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    n = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
