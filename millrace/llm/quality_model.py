"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Every text becomes a short vector of statistics. Cosines of random projections of the standardised
vector approximate a Gaussian kernel. Ridge regression on them needs only the normal equations,
which are summed over the partitions. Isotonic regression on learning rows that the ridge fit has
not seen turns raw scores into the share of good documents among those with such a score, without
tying documents that lie between two steps.

Learning uses about ``sample_rows`` of the labelled rows at most, chosen by a hash of their id; that
bounds the rows of labels that are sent to all tasks. Texts that several labelled rows share, and
ids that are repeated in the labels, are averaged or weigh more, as they come. Null and empty texts
are scored like any other, with statistics of 0. Without labelled rows all scores are 0.5; with
labels of one kind only, that kind is predicted for all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import about, append, column, summed
from millrace.llm.line_cleaning import PHRASE_PATTERN, Judged, Rules
from millrace.llm.words import ALPHANUMERIC, SPACED, Texts, slices, words
from millrace.session import stage

STATISTICS = (
    "log_words", "log_chars", "mean_word", "log_lines", "words_per_line", "mark_share", "symbol_share", "upper_share",
    "digit_share", "wide_share", "stop_share", "bang_share", "pipe_share", "comma_share", "distinct_share", "echo_share",
    "repeat_share", "dup_line_share", "failed_line_share", "lost_share", "hex_share",
)
FEATURES = 256
SAMPLE_ROWS = 40_000


def _counter(data: np.ndarray, bounds: np.ndarray):
    def count(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        return np.diff(sums[bounds])

    return count


def _among(*characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(b"".join(characters), np.uint8)] = True
    return table


UPPER = _among(bytes(range(ord("A"), ord("Z") + 1)))
DIGIT = _among(b"0123456789")
WIDE = _among(bytes(range(0xC0, 0x100)))
GRAPHIC = _among(bytes(range(0x21, 0x80)), bytes(range(0xC0, 0x100)))
PUNCTUATION = _among(bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum()))


def statistics(texts: Texts, phrases: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    rows = len(texts)
    judged = Judged(texts, phrases, Rules())
    count = _counter(texts.data, texts.bounds)
    found = words(texts, SPACED)
    plain = words(texts, ALPHANUMERIC)
    n = np.maximum(1, judged.n_words)
    size = np.maximum(1, count(GRAPHIC))
    lines = np.maximum(1, np.bincount(judged.lines.row, minlength=rows))
    echo = np.zeros(len(plain), bool)
    echo[1:] = (plain.index[1:] == plain.index[:-1]) & (plain.row[1:] == plain.row[:-1])
    order = np.lexsort((found.index, found.row))
    new = np.ones(len(order), bool)
    new[1:] = (found.index[order][1:] != found.index[order][:-1]) | (found.row[order][1:] != found.row[order][:-1])
    distinct = np.bincount(found.row[order][new], minlength=rows)
    long_word = np.bincount(found.row[found.end - found.start > 30], minlength=rows)
    failed = np.bincount(judged.lines.row[judged.failed], minlength=rows)
    columns = (
        np.log1p(judged.n_words), np.log1p(judged.word_chars), judged.word_chars / n, np.log1p(lines), np.log1p(n / lines),
        count(PUNCTUATION) / size, judged.n_symbols / size, count(UPPER) / size, count(DIGIT) / size, count(WIDE) / size,
        count(_among(b".?")) / n, count(_among(b"!")) / n, count(_among(b"|")) / n, count(_among(b",;")) / n,
        distinct / n ** 0.75, np.bincount(plain.row[echo], minlength=rows) / n, judged.n_repeat_words / n,
        judged.n_dup_lines / lines, failed / lines, judged.lost / np.maximum(1, judged.word_chars), long_word / n,
    )
    return np.stack(columns, axis=1).astype(np.float64)


def _statistics_of(values: pa.Array) -> np.ndarray:
    phrases = pc.match_substring_regex(values, PHRASE_PATTERN).fill_null(False).to_numpy(zero_copy_only=False)
    parts = [statistics(p, phrases[p.first:p.first + len(p)]) for p in slices(values)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray  # statistics by features
    phase: np.ndarray
    weights: np.ndarray  # one for each feature, and the intercept
    knots: np.ndarray  # raw scores, ascending
    levels: np.ndarray  # calibrated score at each knot

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        wave = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.projection + self.phase)
        return np.hstack([wave, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        return np.interp(self.raw(stats), self.knots, self.levels)


def isotonic(places: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit to the shares ``good / count`` at ascending places: mean place and level of each step."""
    steps: list[list[float]] = []
    for place, g, n in zip(places.tolist(), good.tolist(), count.tolist(), strict=True):
        steps.append([place * n, g, n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            top = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], top, strict=True)]
    sums = np.array(steps).reshape(-1, 3)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def _stats_matrix(batch: pa.RecordBatch) -> np.ndarray:
    stats = batch.column("stats")
    return np.asarray(stats.flatten()).reshape(len(batch), len(STATISTICS))


def learn(df: DataFrame, id_column: str, text: str, labels: DataFrame, label_id: str, label: str,
          learning: Column | None = None, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES, width: float = 0.15,
          ridge: float = 1e-3, seed: int = 9) -> QualityModel:
    """Model of a 0/1 label from the texts; ``learning`` is a condition on the rows of ``labels``."""
    spark = df.sparkSession
    rows = labels.where(column(labels, label).isNotNull() & column(labels, label_id).isNotNull())
    rows = rows.where(learning) if learning is not None else rows
    rows = rows.groupBy(column(rows, label_id).alias("id")).agg(F.avg(column(rows, label).cast("double")).alias("good"))
    sample = F.broadcast(about(rows, "id", sample_rows))  # about sample_rows rows of two numbers
    texts = df.select(column(df, id_column).alias("id"), column(df, text).alias("text"))

    def make():
        return lambda batch: [pa.FixedSizeListArray.from_arrays(
            pa.array(_statistics_of(batch.column("text")).ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))]

    with_stats = append(texts.join(sample, "id"), "stats array<double>", make, drop=("text",))
    known = stage(with_stats.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(4))), "quality-sample")

    k = len(STATISTICS)

    def moments(batches) -> np.ndarray:
        out = np.zeros(2 * k + 1)
        for batch in batches:
            x = _stats_matrix(batch)
            out += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]])
        return out

    sums = summed(known, moments, 2 * k + 1)
    n = max(1.0, sums[-1])
    mean = sums[:k] / n
    scale = np.sqrt(np.maximum(sums[k:2 * k] / n - mean * mean, 0)) + 1e-6
    draw = np.random.default_rng(seed)
    model = QualityModel(mean, scale, draw.normal(0, width, (k, features)), draw.uniform(0, 2 * np.pi, features),
                         np.zeros(features + 1), np.empty(0), np.empty(0))
    if not sums[-1]:
        return model
    sent, size = spark.sparkContext.broadcast(model), features + 1

    def normal_equations(batches) -> np.ndarray:
        gram, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z = sent.value.features(_stats_matrix(batch))
            gram += z.T @ z
            right += z.T @ batch.column("good").to_numpy()
        return np.concatenate([gram.ravel(), right])

    fitted = known.where("part > 0")
    both = summed(fitted, normal_equations, size * size + size)
    gram, right = both[:size * size].reshape(size, size), both[size * size:]
    penalty = ridge * max(1.0, gram[-1, -1]) * np.eye(size)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(gram + penalty, right)
    bins, low, high = 4096, -1.0, 2.0
    final = spark.sparkContext.broadcast(model)

    def calibration(batches) -> np.ndarray:
        out = np.zeros((2, bins))
        for batch in batches:
            raw = final.value.raw(_stats_matrix(batch))
            place = np.clip(((raw - low) / (high - low) * bins).astype(np.int64), 0, bins - 1)
            out[0] += np.bincount(place, batch.column("good").to_numpy(), bins)
            out[1] += np.bincount(place, minlength=bins)
        return out.ravel()

    held = summed(known.where("part = 0"), calibration, 2 * bins).reshape(2, bins)
    if not held[1].any():
        held = summed(known, calibration, 2 * bins).reshape(2, bins)
    used = np.flatnonzero(held[1])
    places = low + (used + 0.5) * (high - low) / bins
    model.knots, model.levels = isotonic(places, held[0][used], held[1][used])
    return model


def score(df: DataFrame, text: str, model: QualityModel, drop: tuple[str, ...] = ()) -> DataFrame:
    """The frame with ``score`` and ``predicted`` (1 from 0.5); columns of the same names are replaced."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def make():
        own = sent.value

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            scores = own.score(_statistics_of(batch.column(text)))
            return [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())]

        return work

    return append(df, "score double, predicted int", make, drop)
