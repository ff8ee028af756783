"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics describe form only (lengths, letters, signs, repetition), never labels, language, source or id. A random
cosine map approximates a Gaussian kernel over them; partitions sum their part of the normal equations, whose size is
fixed by the number of features; labelled rows kept aside for it calibrate the ridge scores to probabilities.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import cut, text_batches

#: Labelled rows used at most: above this, those with the smallest hash of their id, in expectation.
TRAINING_ROWS = 400_000
_CLASSES = np.zeros(256, dtype=np.int64)
for _name, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"-()", b"!?", b" \t\r\v\f", b"\n"), 1):
    _CLASSES[list(_chars)] = _name
_CLASSES[128:] = 8  # parts of other letters; what is left, class 0, are signs

STATISTICS = (
    "log_bytes", "log_words", "word_length", "long_words", "short_words", "lower", "upper", "digits", "marks", "shouts", "blanks", "breaks",
    "signs", "other_bytes", "upper_start", "distinct_words", "top_word", "repeated_pairs", "line_words", "distinct_lines", "ends_in_mark",
    "word_signs", "words_in_marks", "length_spread", "zip_ratio",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; all zero for a text without words."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(data), len(words)
    share = np.bincount(_CLASSES[np.frombuffer(data, dtype=np.uint8)], minlength=9) / size
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    ends = np.frombuffer(bytes(w[-1] for w in words), dtype=np.uint8)
    starts = np.frombuffer(bytes(w[0] for w in words), dtype=np.uint8)
    end_class = _CLASSES[ends]
    # how the number of distinct words falls behind a text of such length, so that long texts do not look repetitive
    spread = np.log1p(len(counts)) / np.log1p(n)
    packed = len(zlib.compress(data, 1)) / size
    return [
        float(np.log1p(size)), float(np.log1p(n)), float(lengths.mean()), float((lengths > 15).mean()), float((lengths < 3).mean()),
        share[1], share[2], share[3], share[4], share[5], share[6], share[7], share[0], share[8],
        float((_CLASSES[starts] == 2).mean()), float(spread), counts.most_common(1)[0][1] / n, 1 - pairs / max(1, n - 1),
        float(np.log1p(n / len(lines))), len(set(lines)) / len(lines), float((end_class == 4).mean() + (end_class == 5).mean()),
        float((end_class == 0).mean()), float(((end_class == 0) & (lengths == 1)).mean()), float(lengths.std()), float(packed),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([statistics(t) for t in batch])


def held_out_by_id(doc_id: Column) -> Column:
    """The fold that no training sees: CRC-32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class QualityModel:
    """Scales, the cosine map, ridge weights and the calibration: a few hundred kilobytes, whatever the input."""

    mean: np.ndarray
    spread: np.ndarray
    slopes: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -4, 4)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.slopes + self.phases)
        return np.hstack([waves, 0.1 * z, np.ones((len(z), 1))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated, with a thousandth of the ridge score added so that equal levels keep their order."""
        raw = self.ridge(stats)
        level = np.interp(raw, self.knots, self.levels)
        return np.round(np.clip(0.999 * level + 0.001 * np.clip(raw, 0, 1), 0, 1), 9)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares levels by pooling adjacent violators; (mean x, level) of each pool. x is sorted."""
    pools: list[list[float]] = []
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist()):
        pools.append([a * w, b * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _stacked(frame: pd.DataFrame) -> np.ndarray:
    return np.vstack(frame["stats"].to_numpy()) if len(frame) else np.zeros((0, len(STATISTICS)))


def fit(training: DataFrame, waves: int = 384, width: float = 6.0, ridge: float = 0.01, seed: int = 7, bins: int = 1000, parts: int = 16) -> QualityModel:
    """training: columns stats (array), label (0 or 1, not null) and fold (0..4); rows of fold 4 calibrate, the others fit.

    Each of `parts` tasks sums its part of the normal equations and sends one matrix of fixed size to the driver. With no
    rows, or of one label only, every score is the share of label 1 (one half without rows).
    """
    n_stats = len(STATISTICS)
    rng = np.random.default_rng(seed)
    slopes, phases = rng.normal(size=(n_stats, waves)) / width, rng.uniform(0, 2 * np.pi, waves)
    moments = training.agg(
        F.count("*").alias("n"), F.coalesce(F.avg("label"), F.lit(0.5)).alias("share"),
        *[F.coalesce(f(F.col("stats")[i]), F.lit(0.0)).alias(f"{name}{i}") for i in range(n_stats) for name, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    mean = np.array([moments[f"m{i}"] for i in range(n_stats)])
    spread = np.array([moments[f"s{i}"] for i in range(n_stats)]) + 1e-9
    size = waves + n_stats + 1
    flat = QualityModel(mean, spread, slopes, phases, np.zeros(size), np.array([0.0]), np.array([moments["share"]]))
    if moments["share"] in (0, 1) or not moments["n"]:
        return flat

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right, first = np.zeros((size, size)), np.zeros(size), None
        for frame in frames:
            if len(frame):
                x = flat.features(_stacked(frame))
                gram, right = gram + x.T @ x, right + x.T @ frame["label"].to_numpy(dtype=float)
                first = frame["part"].iloc[0] if first is None else first
        if first is not None:
            yield pd.DataFrame({"part": [first], "sums": [np.hstack([gram, right[:, None]]).tobytes()]})

    dealt = training.where("fold <> 4").repartition(parts, "part").sortWithinPartitions("part", "id").select("part", "stats", "label")
    got = sorted(dealt.mapInPandas(sums, "part int, sums binary").collect())
    total = sum((np.frombuffer(r["sums"]).reshape(size, size + 1) for r in got), np.zeros((size, size + 1)))
    weights = np.linalg.solve(total[:, :size] + ridge * np.eye(size), total[:, size])
    fitted = QualityModel(mean, spread, slopes, phases, weights, flat.knots, flat.levels)

    @F.pandas_udf("int")
    def bin_of(stats: pd.Series) -> pd.Series:
        return pd.Series(np.clip(np.floor(fitted.ridge(np.vstack(stats.to_numpy())) * bins), -bins, 2 * bins).astype("int32"))

    curve = training.where("fold = 4").groupBy(bin_of("stats").alias("bin")).agg(F.avg("label").alias("y"), F.count("*").alias("n")).collect()
    curve = np.array(sorted((r["bin"], r["y"], r["n"]) for r in curve), dtype=float).reshape(-1, 3)
    if not len(curve):
        return QualityModel(mean, spread, slopes, phases, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    knots, levels = isotonic((curve[:, 0] + 0.5) / bins, curve[:, 1], curve[:, 2])
    return QualityModel(mean, spread, slopes, phases, weights, knots, levels)


def score_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.3,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """All columns of docs but the text's statistics, with held_out, score (0 to 1) and predicted (1 if score >= threshold).

    labels: doc_id and the label; rows with a null label or id, or of the held-out fold, teach nothing; of several labels of an
    id the smallest counts. At most about training_rows labelled rows train, chosen by a hash of their id; every document
    is scored from its whole text. A null or empty text has all statistics 0 and is scored by them. Repeated rows get
    equal scores; null ids are scored and not held out. Columns of docs with the new names are replaced.
    """
    text_batches(docs.sparkSession)
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out_by_id(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min(label).cast("double").alias("label"))
    )
    share = min(1.0, training_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    described = docs.drop("held_out", "score", "predicted").withColumn("__stats", _statistics_of(F.col(text)))
    training = cut(
        docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text"))
        .join(F.broadcast(known), F.col("__doc") == F.col("__id"))  # at most about training_rows pairs of numbers
        .select(
            F.col("__doc").alias("id"), _statistics_of("__text").alias("stats"), "label",
            (F.crc32(F.col("__doc").cast("string").cast("binary")) % 5).cast("int").alias("fold"),
            F.pmod(F.xxhash64("__doc"), F.lit(16)).cast("int").alias("part"),
        )
    )
    model = docs.sparkSession.sparkContext.broadcast(fit(training))

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(np.vstack(stats.to_numpy())))

    return (
        described.withColumn("score", score("__stats"))
        .withColumns({"held_out": held_out_by_id(F.col(doc_id)), "predicted": (F.col("score") >= threshold).cast("int")})
        .drop("__stats")
    )
