"""Packing of token pieces into as few sequences as possible, by bin completion over a histogram of lengths.

Pieces of one length are alike, so the search needs only how many pieces each length has: at most ``capacity`` rows,
whatever the corpus. Incumbents are a best-fit packing, one that fills bin after bin with the largest pieces that fit, and
one that repeats the filling that wastes least. If none meets the lower bound, bin completion branches over the undominated
fillings around the largest length left, and a branch ends where its total waste leaves no better packing; the search has a
budget of steps, beyond which the best packing seen is taken and not proved the smallest. The plan
is a bounded list of (length, range of numbers, sequences); pieces find their place by their number within their length.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.numbering import blocks_for, numbered
from strata.llm.scratch import stored
from strata.llm.tokens import MOST_WORDS, encoded

CAPACITY = 2048
#: Branches that the search for one filling may open before it takes the best one seen.
BRANCHES = 4_000
#: Steps of the whole search over packings: branches of fillings, and lengths looked at per bin.
STEPS = 2_000_000

Bins = list[tuple[int, tuple[int, ...]]]


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """Best-fit decreasing on a histogram: a piece goes into the open bin with the least room that holds it."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}

    def put(times: int, filling: tuple[int, ...], room: int) -> None:
        if times:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((times, filling))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            at = bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            if at < len(rooms):
                times, filling = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                times, filling = n, ()
            each = min(n, room // length)
            full = min(times, n // each)
            put(full, filling + (length,) * each, room - each * length)
            n -= full * each
            if full < times and n and filling:
                put(1, filling + (length,) * n, room - n * length)
                full, n = full + 1, 0
            if filling:
                put(times - full, filling, room)
    return [bins for room in rooms for bins in open_[room]]


def next_fillings(counts: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """Bins filled one kind after the other, each with the largest pieces left that fit."""
    left = {k: n for k, n in counts.items() if n > 0}
    bins: Bins = []
    while left:
        lengths = sorted(left)
        filling = _greedy(lengths, left, capacity)
        bins.append(_take(left, filling))
    return bins


def _greedy(lengths: list[int], left: dict[int, int], capacity: int) -> tuple[int, ...]:
    filling, room, used = [], capacity, {}
    at = len(lengths) - 1
    while at >= 0:
        at = min(at, bisect_right(lengths, room) - 1)
        if at < 0:
            break
        length = lengths[at]
        if used.get(length, 0) < left[length]:
            used[length] = used.get(length, 0) + 1
            filling.append(length)
            room -= length
        else:
            at -= 1
    return tuple(filling)


def _take(left: dict[int, int], filling: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    need = {k: filling.count(k) for k in set(filling)}
    times = min(left[k] // n for k, n in need.items())
    for k, n in need.items():
        left[k] -= times * n
        if not left[k]:
            del left[k]
    return times, filling


def completion(lengths: list[int], left: dict[int, int], capacity: int, branches: int = BRANCHES) -> tuple[int, ...]:
    """The filling around the largest length that wastes least, of those that ``branches`` branches reach.

    Lengths are tried from large to small, from the greedy filling on. Of two fillings with the same waste the first
    stays; it has the larger pieces, and small ones are easy to place later.
    """
    best = _greedy(lengths, left, capacity)
    waste = capacity - sum(best)
    largest = lengths[-1]
    smallest = lengths[0]
    opened = 0
    # (index of the next length to try, room left, pieces chosen)
    stack: list[tuple[int, int, tuple[int, ...]]] = [(len(lengths) - 1, capacity - largest, (largest,))]
    while stack and waste and opened < branches:
        at, room, chosen = stack.pop()
        opened += 1
        if room < waste:
            best, waste = chosen, room
        if room < smallest or not waste:
            continue
        at = min(at, bisect_right(lengths, room) - 1)
        while at >= 0 and chosen.count(lengths[at]) >= left[lengths[at]]:
            at -= 1
        if at < 0:
            continue
        length = lengths[at]
        if at:
            stack.append((at - 1, room, chosen))
        stack.append((at, room - length, (*chosen, length)))
    return best


def fillings(lengths: list[int], left: dict[int, int], capacity: int, spare: int) -> tuple[list[tuple[int, ...]], bool, int]:
    """The undominated fillings around the largest length that waste ``spare`` at most, the least waste first; if these are all; steps.

    A branch is cut when even all smaller pieces would leave more than ``spare``. A filling is dominated if a piece left
    out fits beside it, or in place of a smaller piece or of two that are together no larger.
    """
    below, whole = [], 0
    for k in lengths:
        whole += k * left[k]
        below.append(whole)

    def free(least: int, most: int, chosen: tuple[int, ...]) -> bool:
        return any(left[k] > chosen.count(k) for k in lengths[bisect_left(lengths, least) : bisect_right(lengths, most)])

    def dominated(chosen: tuple[int, ...], room: int) -> bool:
        rest = chosen[1:]
        return free(1, room, chosen) or any(free(a + 1, a + room, chosen) for a in set(rest)) or any(
            free(a + b, a + b + room, chosen) for a, b in set(combinations(rest, 2)))

    largest = lengths[-1]
    found: list[tuple[int, tuple[int, ...]]] = []
    stack: list[tuple[int, int, tuple[int, ...]]] = [(len(lengths) - 1, capacity - largest, (largest,))]
    opened = 0
    while stack and opened < BRANCHES:
        at, room, chosen = stack.pop()
        opened += 1
        at = min(at, bisect_right(lengths, room) - 1)
        while at >= 0 and chosen.count(lengths[at]) >= left[lengths[at]]:
            at -= 1
        if at < 0:
            if room <= spare and not dominated(chosen, room):
                found.append((room, chosen))
            continue
        if room - below[at] > spare:
            continue
        if at:
            stack.append((at - 1, room, chosen))
        stack.append((at, room - lengths[at], (*chosen, lengths[at])))
    return [chosen for _, chosen in sorted(found, key=lambda f: f[0])], not stack, opened


def _size(bins: Bins) -> int:
    return sum(t for t, _ in bins)


def searched(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[Bins, bool]:
    """``(times, lengths)`` of the sequences, and whether it is proved that no packing has fewer."""
    left = {k: n for k, n in counts.items() if n > 0}
    total = sum(k * n for k, n in left.items())

    def floor(pieces: dict[int, int], length: int) -> int:
        return max(-(-length // capacity), sum(n for k, n in pieces.items() if 2 * k > capacity))

    def completed() -> Bins:
        rest, bins = dict(left), []
        while rest:
            bins.append(_take(rest, completion(sorted(rest), rest, capacity)))
        return bins

    least = floor(left, total)
    best: Bins | None = None
    for make in (lambda: best_fit(left, capacity), lambda: next_fillings(left, capacity), completed):
        bins = make()
        best = bins if best is None or _size(bins) < _size(best) else best
        if _size(best) == least:
            return best, True

    whole, bins, used, waste, seen = True, [], 0, 0, {}

    def branches() -> Iterator[tuple[int, tuple[int, ...]]]:
        nonlocal whole, steps
        spare = (_size(best) - 1) * capacity - total - waste
        rest = {k: n for k, n in left.items() if n}
        steps -= len(left)
        state = hashlib.blake2b(repr(list(rest.items())).encode(), digest_size=16).digest()
        if used >= seen.get(state, used + 1) or used + floor(rest, total + waste - used * capacity) >= _size(best):
            return
        seen[state] = used
        found, all_, opened = fillings(sorted(rest), rest, capacity, spare)
        whole, steps = whole and all_, steps - opened
        for filling in found:
            most = min(rest[k] // filling.count(k) for k in set(filling))
            # As often as the counts allow is tried first; once, and then any filling again, stands for all else.
            yield from ((times, filling) for times in ([most, 1] if most > 1 else [1]))

    def apply(times: int, filling: tuple[int, ...]) -> None:
        nonlocal used, waste
        for k in filling:
            left[k] -= times
        used += times
        waste += times * (capacity - sum(filling))

    open_ = [branches()]
    while open_ and steps > 0:
        step = next(open_[-1], None)
        if step is None:
            open_.pop()
            if bins:
                times, filling = bins.pop()
                apply(-times, filling)
            continue
        apply(*step)
        bins.append(step)
        if waste > (_size(best) - 1) * capacity - total:
            apply(-step[0], step[1])
            bins.pop()
        elif not any(left.values()):
            best = list(bins)
            if used == least:
                return best, True
            apply(-step[0], step[1])
            bins.pop()
        else:
            open_.append(branches())
    return best, whole and not open_


def packed_bins(counts: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """``(times, lengths)`` of the sequences: the smallest packing that the search finds."""
    return searched(counts, capacity)[0]


def cut(ids: bytes, end: int, capacity: int = CAPACITY) -> list[dict]:
    """Pieces of a document's ids with the end id appended; only longer documents are cut."""
    whole = ids + np.array([end], dtype="<u4").tobytes()
    return [
        {"piece": i, "start": at // 4, "length": min(capacity, (len(whole) - at) // 4), "ids": whole[at : at + 4 * capacity]}
        for i, at in enumerate(range(0, len(whole), 4 * capacity))]


def pieces(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", end: int = 0, capacity: int = CAPACITY, most_words: int = MOST_WORDS,
) -> DataFrame:
    """Per piece: ``key``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit integers).

    A null or empty text is one piece, the end id. Repeated rows and null keys give pieces of their own.
    """
    schema = "piece int, start bigint, length bigint, ids binary"
    return encoded(docs, key, text, path, lambda ids: cut(ids, end, capacity), schema, most_words).withColumnRenamed("_key", key)


def placed(rows: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (a stored frame with ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    The lengths of a sequence add up to ``capacity`` at most, and offsets leave no gaps. An empty table stays empty.
    """
    listed = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, used, sequence = [], dict.fromkeys(listed, 0), 0
    for times, filling in packed_bins(listed, capacity):
        offset = 0
        for length in dict.fromkeys(filling):
            each = filling.count(length)
            plan.append((length, used[length], used[length] + each * times, each, sequence, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    spark = rows.sparkSession
    schema = "length bigint, _from bigint, _to bigint, _each bigint, _sequence bigint, _offset bigint"
    # One row per length, its ranges in an array: at most a few entries per length, so the broadcast is bounded by the capacity.
    ranges = spark.createDataFrame(plan, schema).groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("_from", "_to", "_each", "_sequence", "_offset"))).alias("_ranges"))
    count = sum(listed.values())
    mostly = max(listed.values(), default=0)
    ranked = numbered(rows, ["length"], order, "_rank", blocks_for(max(mostly, count // 64)))
    at = F.get(F.filter("_ranges", lambda r: (r["_from"] <= F.col("_rank")) & (F.col("_rank") < r["_to"])), F.lit(0))
    found = ranked.join(F.broadcast(ranges), "length").withColumn("_at", at)
    step = F.col("_rank") - F.col("_at._from")
    return found.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        (F.col("_at._sequence") + F.floor(step / F.col("_at._each")).cast("bigint")).alias("sequence_id"),
        (F.col("_at._offset") + step % F.col("_at._each") * F.col("length")).alias("offset"))


def pack(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", end: int = 0, capacity: int = CAPACITY, most_words: int = MOST_WORDS,
) -> DataFrame:
    """Per piece of every document: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    found = pieces(docs, path, key=key, text=text, end=end, capacity=capacity, most_words=most_words)
    rows = stored(found.withColumn("ids_crc32", F.crc32("ids").cast("bigint")).drop("ids"), "pieces")
    return placed(rows, [key, "piece", "ids_crc32"], capacity)


def sequences(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", end: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``ids``, the joined ids of its pieces in order of their offsets."""
    rows = stored(pieces(docs, path, key=key, text=text, end=end, capacity=capacity).withColumn("ids_crc32", F.crc32("ids").cast("bigint")), "pieces")
    where = placed(rows, [key, "piece", "ids_crc32"], capacity)
    parts = where.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids"))
