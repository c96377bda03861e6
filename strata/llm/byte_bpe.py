"""Byte-level BPE by ranks: the merges of many distinct words at once, in arrays; decoding joins the pieces by built-in functions.

Documents are read once. A task splits a block of texts by the pattern and lists the block's distinct words once; their bytes lie in one
array, and each round merges the pair of the least rank of every word that still has one. The task's documents are put together from
the ids of their words. Nothing is shuffled, and a block's size bounds what a task holds.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.memory import give_back

#: Characters of text whose distinct words are listed together, and bytes of words that are merged together.
BLOCK_CHARS = 24 << 20
MERGED_BYTES = 1 << 20
_NONE = 2**31 - 1


def load(path: str) -> list[bytes]:
    """The pieces of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


class Merges(NamedTuple):
    """Names of pieces are their ranks; a byte that is no piece has a name after them."""

    names: dict[bytes, int]
    first: np.ndarray  #: the name of every byte
    bytes_: np.ndarray  #: the rank of every pair of bytes
    pairs: np.ndarray  #: pairs of names that make a piece (left name times ``size`` plus right name), ascending
    ranks: np.ndarray  #: the rank of each such piece
    size: int
    pieces: int
    #: Whether no pair with the piece in it has a lesser rank than the piece: then all its places in a word can be merged together.
    alone: np.ndarray


def merges(pieces: list[bytes]) -> Merges:
    """What the merges need of a rank file, by arrays."""
    names = {piece: rank for rank, piece in enumerate(pieces) if piece}
    every = {**{bytes([b]): len(pieces) + b for b in range(256)}, **names}
    size = len(pieces) + 256
    found = [(every[k[:i]], every[k[i:]], rank) for k, rank in names.items() for i in range(1, len(k)) if k[:i] in every and k[i:] in every]
    left, right, made = np.array(found, dtype=np.int64).reshape(-1, 3).T
    order = np.argsort(left * size + right)
    first = np.array([every[bytes([b])] for b in range(256)], dtype=np.int32)
    bytes_ = np.array([names.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)], dtype=np.int32)
    alone = np.ones(size, dtype=bool)
    alone[left[made < left]] = False
    alone[right[made < right]] = False
    return Merges(names, first, bytes_, (left * size + right)[order], made[order].astype(np.int32), size, len(pieces), alone)


def _rank(of: Merges, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    if not len(of.pairs):
        return np.full(len(left), _NONE, np.int32)
    pair = left.astype(np.int64) * of.size + right
    at = np.minimum(np.searchsorted(of.pairs, pair), len(of.pairs) - 1)
    return np.where(of.pairs[at] == pair, of.ranks[at], _NONE).astype(np.int32)


def merged(words: list[bytes], of: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, one after another, and how many each has. A word that is a piece is that piece; else the pair of neighbours with
    the least rank, the leftmost of equal ones, is merged until no pair has a rank."""
    sizes = np.ones(len(words), np.int64)
    whole = [of.names.get(w, -1) for w in words]
    ids = np.array(whole, dtype=np.int32)
    open_ = np.flatnonzero(ids < 0)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.flatnonzero(ids >= 0), sizes[ids >= 0], ids[ids >= 0])]
    lengths = np.array([len(words[i]) for i in open_.tolist()], dtype=np.int64)
    parts = np.cumsum(lengths) // MERGED_BYTES
    for part in np.split(np.arange(len(open_)), np.flatnonzero(np.diff(parts)) + 1) if len(open_) else []:
        done += _folded(open_[part], lengths[part], b"".join([words[i] for i in open_[part].tolist()]), of)
    which, sizes, ids = (np.concatenate(c) for c in zip(*done, strict=True))
    # Back into the order of the words.
    order = np.argsort(which, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    ends = np.cumsum(sizes)
    ids = ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(len(ids))]
    return np.where(ids < of.pieces, ids, _NONE).astype(np.int32), sizes


def _folded(which: np.ndarray, sizes: np.ndarray, text: bytes, of: Merges) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers, sizes and ids of the words that lie in ``text`` one after another, in the order in which they are done."""
    done = []
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.int32)
    ids = of.first[raw]
    ranks = np.full(len(raw), _NONE, np.int32)  # of the pair that begins at a place
    ranks[:-1] = of.bytes_[raw[:-1] * 256 + raw[1:]]
    ranks[np.cumsum(sizes) - 1] = _NONE
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        least = np.minimum.reduceat(ranks, starts)
        more = least < _NONE
        if not more.all():
            inside = np.repeat(more, sizes)
            done.append((which[~more], sizes[~more], ids[~inside]))
            which, sizes, least, ids, ranks = which[more], sizes[more], least[more], ids[inside], ranks[inside]
            if not len(sizes):
                break
        word = np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(ranks == least[word])
        # Of places in a row each second one is left once its neighbour is merged. If a merge may bring a lesser rank about, it is done alone.
        new = np.ones(len(at), dtype=bool)
        new[1:] = np.diff(at) > 1
        begins = np.flatnonzero(new)
        nth = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
        leftmost = np.ones(len(at), dtype=bool)
        leftmost[1:] = np.diff(word[at]) > 0
        at = at[(nth % 2 == 0) & (leftmost | of.alone[least[word[at]]])]
        ids[at] = least[word[at]]
        keep = np.ones(len(ids), dtype=bool)
        keep[at + 1] = False
        sizes = sizes - np.bincount(word[at], minlength=len(sizes))
        at = at - np.arange(len(at))
        ids, ranks, word = ids[keep], ranks[keep], word[keep]
        changed = np.concatenate([at, at[at > 0] - 1])
        changed = changed[changed + 1 < len(ids)]
        same = word[changed] == word[changed + 1]
        ranks[at] = _NONE
        changed = changed[same]
        ranks[changed] = _rank(of, ids[changed], ids[changed + 1])
    return done


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by ``ids``, the ids of the whole text. Null and empty texts have no ids; every row is encoded on its own.

    The other columns are kept, so choose those that are needed; a column ``ids`` must not be among them.
    A word of many letters takes a round for each different piece that its merges make.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.col(f"`{text}`"))
    keep = [f for f in docs.schema.fields if f.name != text]
    shared = docs.sparkSession.sparkContext.broadcast(merges(load(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        known: dict[str, int] = {}
        held: list[tuple[list[pa.Array], list[np.ndarray]]] = []
        size = 0

        def block() -> Iterator[pa.RecordBatch]:
            flat, sizes = merged([w.encode("utf-8", "replace") for w in known], shared.value)
            starts = np.cumsum(sizes) - sizes
            for columns, places in held:
                code = np.concatenate(places)
                each = sizes[code]
                ends = np.cumsum(each)
                ids = flat[np.repeat(starts[code] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
                cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, places)])]
                found = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*columns, found], [*[f.name for f in keep], "ids"])

        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                rows = whole.slice(at, 100)
                places = []
                for content in rows.column(len(keep)).to_pylist():
                    places.append(np.array([known.setdefault(w, len(known)) for w in split(content or "")], dtype=np.uint32))
                    size += len(content or "")
                held.append((rows.columns[:-1], places))
                if size >= BLOCK_CHARS:
                    yield from block()
                    known, held, size = {}, [], 0
        if held:
            yield from block()
            known, held = {}, []
        give_back()

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)
    return docs.mapInArrow(run, f"{kinds}ids array<int>")


def decode(ids: Column, path: str) -> Column:
    """The bytes of ids: their pieces from a literal list, joined. Null ids give null, ids without a piece none."""
    pieces = F.from_json(F.lit(json.dumps([p.hex() for p in load(path)])), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))
