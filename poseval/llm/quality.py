"""Quality classifier: ridge regression on random Fourier features, isotonic calibration.

A document is described by a few statistics of its whole text. Random Fourier
features approximate a Gaussian kernel over them, so ridge regression on the
features is kernel regression whose cost does not grow with the documents. Each
task sums its share of the normal equations; the sums (a few hundred rows of a
few hundred numbers, whatever the table's size) are solved on the driver. One
model per fold gives scores for the rows it has not seen, and those scores,
counted in fixed bins, are calibrated by pooling adjacent violators.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import crc_of_id, staged, texts
from poseval.schema import require_columns

FEATURES = 256
FOLDS = 4
RIDGE = 3.0
BINS = 1024
#: Standardised statistics are cut here, so that odd documents stay within what was learnt.
REACH = 4.0
THRESHOLD = 0.3
#: Documents with crc32(id) mod 5 = 0 are held out of training.
HELD_OUT = 5

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "stop": b".,;:",
    "cry": b"!?",
    "symbol": b"#$%&*|~^<>=@+\\_/{}[]`",
    "quote": b"'\"()-",
    "space": b" \t\x0b\x0c\r",
    "line": b"\n",
    "wide": range(128, 256),
}
_MEMBER = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES.values()):
    _MEMBER[list(_bytes), _k] = 1
STATISTICS = [
    "bytes", "words", "word_bytes", *_CLASSES, "upper_of_letters", "entropy", "distinct_words", "longest_word",
    "distinct_lines", "line_words", "marked_words", "capital_words",
]


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text of any length; an empty text has defined ones, too."""
    n = max(len(text), 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = (counts @ _MEMBER) / n
    some = counts[counts > 0] / n
    words, lines = text.split(), text.split(b"\n")
    w = max(len(words), 1)
    letters = share[0] + share[1]
    full = [x for x in lines if x.strip()]
    marked = sum(text.count(m) for m in (b"!! ", b"*** ", b"%%% ", b"### ", b"$$$ ", b"&&& "))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / w if words else 0.0,
        *np.sqrt(share).tolist(),
        share[0] / letters if letters else 0.0,
        float(-(some * np.log2(some)).sum()),
        len(set(words)) / w,
        np.log1p(max(map(len, words), default=0)),
        len(set(full)) / max(len(full), 1),
        np.log1p(len(words) / max(len(full), 1)),
        np.sqrt(marked / w),
        sum(1 for x in words if x[:1].isupper()) / w,
    ]


def statistics_of(texts: Iterable[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))


class Fourier(NamedTuple):
    """Standardisation and random frequencies: the same for every run over the same table."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray

    @classmethod
    def make(cls, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES) -> "Fourier":
        rng, d = np.random.default_rng(11), len(mean)
        # Kernel width: the distance of two typical standardised documents is about sqrt(2 d).
        return cls(mean, scale, rng.normal(0, 1 / np.sqrt(d), (d, features)), rng.uniform(0, 2 * np.pi, features))

    def map(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -REACH, REACH)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])


class QualityModel(NamedTuple):
    fourier: Fourier
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if len(x) == 0:
            return np.zeros(0)
        return np.interp(self.fourier.map(x) @ self.weights, self.knots, self.values)


def pooled(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing means: adjacent violators are pooled."""
    blocks: list[list[float]] = []
    for w, t in zip(weight.tolist(), total.tolist()):
        blocks.append([w, t, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, t2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + t2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), t / w) for w, t, n in blocks]) if blocks else np.zeros(0)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, crc, x``: the statistics as an array."""
    rows = texts(docs).select("doc_id", crc_of_id().alias("crc"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array(list(statistics_of(t.as_py() for t in b.column(2))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), x], names=["doc_id", "crc", "x"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, crc long, x array<double>")


def _equations(rows: DataFrame, fourier: Fourier) -> dict[int, np.ndarray]:
    """Per fold the sum of z z' with z y and y in the last columns."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            fold, y = np.asarray(b.column(0)), np.asarray(b.column(2))
            z = fourier.map(np.array(b.column(1).to_pylist()))
            for f in np.unique(fold).tolist():
                own = z[fold == f]
                made = np.hstack([own.T @ own, (own.T @ y[fold == f])[:, None]])
                sums[f] = sums.get(f, 0) + made
        for f, total in sums.items():
            n = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                names=["fold", "line", "sums"],
            )

    def add(lines: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(lines["sums"].to_list()), axis=0)
        return pd.DataFrame({"fold": lines["fold"][:1], "line": lines["line"][:1], "sums": [total]})

    schema = "fold int, line int, sums array<double>"
    parts = rows.select("fold", "x", "y").mapInArrow(part, schema)
    lines = parts.groupBy("fold", "line").applyInPandas(add, schema).collect()
    out: dict[int, dict[int, list]] = {}
    for r in lines:
        out.setdefault(r["fold"], {})[r["line"]] = r["sums"]
    return {f: np.array([by[k] for k in range(len(by))]) for f, by in out.items()}


def _solve(equations: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights; the last feature is the constant and not penalised."""
    a = equations[:, :-1].copy()
    a[np.diag_indices(len(a) - 1)] += ridge
    return np.linalg.lstsq(a, equations[:, -1], rcond=None)[0]


def fit(stats: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> QualityModel:
    """Model of ``labels.quality`` from the labelled rows that are not held out.

    Documents with several labels take their mean; null labels are none.
    Without any labels every score is 0.5.
    """
    require_columns(labels, ["doc_id", "quality"])
    d = len(STATISTICS)
    moments = stats.agg(
        *[F.coalesce(F.avg(F.col("x")[k]), F.lit(0.0)).alias(f"m{k}") for k in range(d)],
        *[F.coalesce(F.stddev_pop(F.col("x")[k]), F.lit(0.0)).alias(f"s{k}") for k in range(d)],
    ).first()
    fourier = Fourier.make(np.array(moments[:d]), np.maximum(np.array(moments[d:]), 1e-6), features)
    target = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    learn = stats.where(F.col("crc") % HELD_OUT != 0).join(target, "doc_id")
    fold = F.pmod(F.floor(F.col("crc") / HELD_OUT), F.lit(FOLDS)).cast("int").alias("fold")
    learn = staged(learn.select(fold, "x", "y"), "labelled")
    parts = _equations(learn, fourier)
    if not parts:
        return QualityModel(fourier, np.zeros(features + 1), np.array([0.0]), np.array([0.5]))
    total = sum(parts.values())
    unseen = {f: _solve(total - own if len(parts) > 1 else total, ridge) for f, own in parts.items()}
    low, high = -0.5, 1.5

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fold, y = np.asarray(b.column(0)), np.asarray(b.column(2))
            z = fourier.map(np.array(b.column(1).to_pylist()).reshape(-1, d))
            raw = np.einsum("ij,ij->i", z, np.array([unseen[f] for f in fold.tolist()]).reshape(z.shape))
            at = np.clip((raw - low) / (high - low) * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(y)], names=["bin", "y"])

    counted = learn.mapInArrow(binned, "bin int, y double").groupBy("bin")
    bins = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()
    knots = np.array([low + (r["bin"] + 0.5) * (high - low) / BINS for r in bins])
    values = pooled(np.array([float(r["n"]) for r in bins]), np.array([r["y"] for r in bins]))
    return QualityModel(fourier, _solve(total, ridge), knots, values)


def with_score(docs: DataFrame, model: QualityModel, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of each row's text; nothing is shuffled."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores(statistics_of(text)))

    return docs.withColumn(name, score(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def predicted(score: Column) -> Column:
    return F.when(score >= THRESHOLD, 1).otherwise(0)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    A null text is empty; empty texts are scored like any other. Repeated rows
    get equal scores. A null id is never labelled. An empty table gives no
    rows; other columns are ignored.
    """
    stats = staged(document_statistics(docs), "statistics")
    model = fit(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = model.scores(np.array(b.column(2).to_pylist()).reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found)], names=["doc_id", "crc", "score"])

    schema = f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, crc long, score double"
    return stats.mapInArrow(run, schema).select(
        "doc_id", (F.col("crc") % HELD_OUT == 0).alias("held_out"), "score", predicted(F.col("score")).alias("predicted")
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns."""
    model = fit(staged(document_statistics(docs), "statistics"), labels)
    name = "score"
    while name in docs.columns:
        name += "_"
    return with_score(docs, model, name=name).where(predicted(F.col(name)) == 1).drop(name)
