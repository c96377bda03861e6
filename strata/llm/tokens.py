"""Token ids of whole texts by the tokenizers library, with a bounded cache of words in each Python worker.

Texts repeat their words, so a worker encodes a new word once and joins the ids of known ones. Texts are
cut only where the tokenizer's own pre-tokenizer always cuts (before a blank, around a line end, before punctuation), so
ids are those of the whole text; texts with other or repeated white space are given to the library whole.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Words that a worker keeps at most; beyond that it starts anew.
MOST_WORDS = 900_000
#: Bytes of text that are encoded together.
SLICE_BYTES = 4 << 20

#: White space of the tokenizers but for a blank and a line end, and the control characters that Arrow and Python
#: alone take for white space. Fixed values.
_OTHER = "\\t\\r\\x0b\\x0c\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
#: A letter or digit before a mark of punctuation other than an apostrophe. Fixed values.
_AFTER_WORD = r"([A-Za-z0-9])([.,;:!?%$&*#|()\-])"
_MARK = "\x1f"
#: More than the ids of any piece of a text.
_SPAN = 1 << 32
_CONTROL = "\\x1c-\\x1f"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.most_words = most_words
        self.words: dict[str, int] = {}
        self.flat = array("I")
        probe = self.library.encode("a b", add_special_tokens=False).ids
        apart = [self.library.encode(x, add_special_tokens=False).ids for x in ("a", "b")]
        #: Whether blanks only separate words, or belong to the word after them.
        self.drops_space = probe == apart[0] + apart[1]

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _known(self, words: list[str]) -> np.ndarray:
        """Place in ``flat`` times ``_SPAN`` plus number of ids, of every word."""
        if len(self.words) > self.most_words:
            self.words.clear()
            self.flat = array("I")
        found = list(map(self.words.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        for at in range(0, len(new), 5_000):
            part = new[at : at + 5_000]
            fresh = [words[i] for i in part]
            ids = [x.ids for x in self.library.encode_batch_fast(fresh, add_special_tokens=False)]
            sizes = list(map(len, ids))
            places = [start * _SPAN + size for start, size in zip(accumulate(sizes, initial=len(self.flat)), sizes)]
            self.flat.extend(chain.from_iterable(ids))
            self.words.update(zip(fresh, places, strict=True))
            for i, place in zip(part, places, strict=True):
                found[i] = place
        return np.fromiter(found, dtype=np.int64, count=len(found))

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text; nulls count as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = f"[{_CONTROL}]" if self.drops_space else f"[{_OTHER}{_CONTROL}]|[ \\n][ \\n]|^[ \\n]|[ \\n]$"
        plain = pc.invert(pc.match_substring_regex(texts, odd))
        marked = pc.replace_substring_regex(texts.filter(plain), _AFTER_WORD, f"\\1{_MARK}\\2")
        marked = pc.replace_substring(pc.replace_substring(marked, " ", f"{_MARK} "), "\n", f"{_MARK}\n{_MARK}")
        joined = iter(self._joined(pc.split_pattern(marked, _MARK)))
        return [next(joined) if p else self.whole(t.as_py()) for t, p in zip(texts, plain.to_pylist(), strict=True)]

    def _joined(self, cut: pa.Array) -> list[bytes]:
        words = cut.flatten().dictionary_encode()
        code = words.indices.to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])
        starts, sizes = np.divmod(self._known(words.dictionary.to_pylist()), _SPAN)
        each = sizes[code]
        ends = np.cumsum(each)
        at = np.repeat(starts[code] - (ends - each), each) + np.arange(len(code) and ends[-1])
        ids = np.frombuffer(self.flat, dtype=np.uint32)[at].astype("<u4", copy=False) if len(self.flat) else np.empty(0, dtype="<u4")
        ends = np.concatenate([[0], ends])[bounds]
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, most_words: int = MOST_WORDS) -> Encoder:
    """The worker's encoder for a tokenizer file; it lives as long as the worker. A task has one core, so the library starts no
    threads of its own unless the environment asks for them."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].most_words = most_words
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch, text: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most_bytes`` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
    parts = np.cumsum(sizes) // most_bytes
    for at in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(parts)) + 1) if len(sizes) else []:
        yield batch.slice(at[0], len(at))


def encoded(
    docs: DataFrame, key: str, text: str, path: str, per_text: Callable[[bytes], list[dict]], schema: str, most_words: int = MOST_WORDS,
) -> DataFrame:
    """Rows that ``per_text`` makes from each text's ids, after ``key``; null texts count as empty.

    ``most_words`` trades a worker's memory for time; slices of text shrink with it.
    """
    slice_bytes = min(SLICE_BYTES, 10 * most_words)
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, most_words)
        shape = None
        for whole in batches:
            for batch in slices(whole, 1, slice_bytes):
                keys, rows = [], []
                for k, ids in zip(batch.column(0).to_pylist(), own.batch(batch.column(1)), strict=True):
                    for row in per_text(ids):
                        keys.append(k)
                        rows.append(row)
                if rows:
                    shape = shape or batch.schema.field(0).type
                    columns = [pa.array(keys, shape)] + [_array(name, [r[name] for r in rows]) for name in rows[0]]
                    yield pa.RecordBatch.from_arrays(columns, ["_key", *rows[0]])
                    pa.default_memory_pool().release_unused()

    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, f"_key {kind}, {schema}")


def _array(name: str, values: list) -> pa.Array:
    if name == "ids":
        return pa.array(values, pa.binary())
    return pa.array(values, pa.int32() if name == "piece" else pa.int64())
