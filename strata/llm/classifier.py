"""Quality classifier: random Fourier features, ridge scores by summed normal equations, isotonic calibration.

The features are statistics of a document's whole text. Their cosines at random frequencies approximate a
Gaussian kernel. Tasks sum the normal equations of their rows; the sums are added row by row of the
matrix on the cluster, so the driver receives one matrix per fold, whatever the number of rows or tasks.
Scores of rows outside their own fold then fit a monotone step curve, which turns scores into probabilities.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.memory import give_back
from strata.llm.scratch import stored

#: Classes of bytes that the statistics count. Fixed values.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c", "line": b"\n", "stop": b".?", "comma": b",;:", "shout": b"!", "symbol": b"#*$%&<>@^~=+_\\{}[]",
    "pipe": b"|", "quote": b"'\"()-/`", "high": bytes(range(128, 256)),
}
_TABLE = np.full(256, len(CLASSES), dtype=np.int64)
for _i, _bytes in enumerate(CLASSES.values()):
    _TABLE[list(_bytes)] = _i

STATISTICS = (
    "log_words", "log_lines", *(f"share_{c}" for c in CLASSES), "mean_word", "long_words", "short_words", "distinct_words",
    "top_word", "top_pair", "repeated_lines", "mean_line", "marked_words", "capital_words", "upper_words", "compression",
)
FOLDS = 4
SEED = 20240229


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; null counts as empty, and an empty text has zeros."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    shares = np.bincount(_TABLE[np.frombuffer(data, dtype=np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)] / len(data)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [x for x in data.split(b"\n") if x.strip()]
    last = Counter(w[-1] for w in words)
    first = Counter(w[0] for w in words)
    plain = sum(c for k, c in last.items() if 97 <= k <= 122 or 65 <= k <= 90 or 48 <= k <= 57 or k >= 128 or k in b".,")
    return [
        np.log1p(n), np.log1p(len(lines)), *shares, lengths.mean(), (lengths > 15).mean(), (lengths < 3).mean(),
        len(counts) / n, max(counts.values()) / n, max(pairs.values(), default=0) / n, 1 - len(set(lines)) / len(lines),
        np.log1p(len(data) / len(lines)), 1 - plain / n, sum(c for k, c in first.items() if 65 <= k <= 90) / n,
        sum(c for w, c in counts.items() if w.isupper()) / n, len(zlib.compress(data, 1)) / len(data),
    ]


@dataclass(frozen=True)
class Model:
    """A fitted classifier; its size does not depend on the rows it was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        return _features(x, self.mean, self.scale, self.frequencies, self.phases)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores of rows of statistics."""
        return np.clip(np.interp(self.features(x) @ self.weights, self.steps, self.values), 0.0, 1.0)


def _features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, frequencies: np.ndarray, phases: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    waves = np.cos(z @ frequencies + phases) * np.sqrt(2 / len(phases))
    return np.hstack([waves, np.ones((len(x), 1))])


def isotonic(score: np.ndarray, rows: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbours that break the order: positions and values of a curve that never falls."""
    blocks: list[list[float]] = []
    for s, n, k in sorted(zip(score.tolist(), rows.tolist(), ones.tolist(), strict=True)):
        blocks.append([s * n, n, k])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``statistics``, an array of doubles."""
    fields = [f for f in docs.select(*keep).schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", statistics array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([statistics(t.as_py()) for t in batch.column(len(keep))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [found], [*keep, "statistics"])
        give_back()

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    most_rows: int = 200_000, waves: int = 256, ridge: float = 1e-4,
) -> Model:
    """Fit on the labelled rows of ``docs``.

    At most about ``most_rows`` labelled rows are used, chosen by a hash of the key; all others are scored
    only. Rows with a null key or label teach nothing. A key labelled more than once counts once, with its largest label.
    Without any labelled row, or with one class only, the model gives every text that class's share (0.5 without rows).
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where("_key IS NOT NULL AND _label IN (0, 1)")
    known = known.groupBy("_key").agg(F.max("_label").alias("_label"))
    share = min(1.0, most_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) < int(share * (1 << 30)))
    narrow = with_statistics(docs.where(F.col(key).isNotNull()), text, [key]).withColumnRenamed(key, "_key")
    rows = stored(
        narrow.join(known, "_key").select(
            F.pmod(F.xxhash64(F.lit("fold"), "_key"), F.lit(FOLDS)).cast("int").alias("fold"), "_label", "statistics"),
        "classifier-rows")

    d = len(STATISTICS)
    sums = rows.agg(
        F.count(F.lit(1)), F.sum("_label"),
        *[F.avg(F.col("statistics")[i]) for i in range(d)], *[F.stddev_pop(F.col("statistics")[i]) for i in range(d)]).first()
    n, positive = sums[0], sums[1] or 0
    draw = np.random.default_rng(SEED)
    frequencies = draw.normal(size=(d, waves)) / np.sqrt(d / 2)
    phases = draw.uniform(0, 2 * np.pi, waves)
    if not 0 < positive < n:
        flat = np.array([positive / n if n else 0.5])
        return Model(np.zeros(d), np.ones(d), frequencies, phases, np.zeros(waves + 1), np.zeros(1), flat)
    mean = np.array(sums[2 : 2 + d], dtype=float)
    scale = np.array(sums[2 + d :], dtype=float)
    scale[scale < 1e-9] = 1.0

    def sum_equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, waves + 1, waves + 2))
        for batch in batches:
            fold = batch.column(0).to_numpy()
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            z = _features(np.array(batch.column(2).to_pylist()), mean, scale, frequencies, phases)
            for k in range(FOLDS):
                part = z[fold == k]
                total[k] += part.T @ np.hstack([part, y[fold == k][:, None]])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(FOLDS), waves + 1), pa.int32()), pa.array(np.tile(np.arange(waves + 1), FOLDS), pa.int32()),
            pa.array(list(total.reshape(-1, waves + 2)), pa.list_(pa.float64()))], ["fold", "line", "sums"])

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": [key[0]], "line": [key[1]], "sums": [np.sum(np.stack(part["sums"].to_list()), axis=0)]})

    shape = "fold int, line int, sums array<double>"
    lines = rows.mapInArrow(sum_equations, shape).groupBy("fold", "line").applyInPandas(add, shape).toArrow()
    equations = np.zeros((FOLDS, waves + 1, waves + 2))
    for fold, line, values in zip(*(lines.column(i).to_pylist() for i in range(3)), strict=True):
        equations[fold, line] = values

    def solve(e: np.ndarray) -> np.ndarray:
        g = e[:, :-1] + ridge * max(e[-1, -2], 1.0) * np.eye(waves + 1)
        return np.linalg.solve(g, e[:, -1])

    whole = equations.sum(axis=0)
    apart = np.stack([solve(whole - equations[k]) for k in range(FOLDS)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _features(np.array(batch.column(2).to_pylist()), mean, scale, frequencies, phases)
            s = np.einsum("ij,ij->i", z, apart[batch.column(0).to_numpy()])
            yield pa.RecordBatch.from_arrays([pa.array(np.round(s, 3)), batch.column(1)], ["score", "label"])

    grid = rows.mapInArrow(judge, "score double, label int").groupBy("score").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("ones")).toPandas()
    steps, values = isotonic(*(grid[c].to_numpy(float) for c in ("score", "rows", "ones")))
    return Model(mean, scale, frequencies, phases, solve(whole), steps, values)


def score(model: Model, text: Column) -> Column:
    """Calibrated probability of label 1 for a whole text; null counts as empty."""

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            x = np.array([statistics(t) for t in part], dtype=float).reshape(len(part), len(STATISTICS))
            yield pd.Series(model.probability(x))
        give_back()

    return run(text)


def accepted(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with the columns of ``docs``."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    return held.where(score(model, F.col("_text")) >= least).select("_row.*")
