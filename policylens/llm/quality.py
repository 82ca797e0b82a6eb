"""Quality classifier by compression with good and bad dictionaries.

Two zstandard dictionaries are trained, one from pieces of texts labelled
good and one from pieces of texts labelled bad.  A text is cut into pieces of
``PIECE`` bytes, each compressed with either dictionary on its own, so a long
text cannot become its own dictionary.  The feature is the difference of the
summed sizes over their sum.  A second one is how much smaller the text gets
than texts do usually: repetitive text helps itself more than any dictionary.
A logistic curve over both, fitted on other labelled rows, is the score.

Learning is bounded: the dictionaries see at most ``DICTIONARY_PIECES`` pieces
per label from at most ``SAMPLE_ROWS`` labelled rows, the curve at most
``SAMPLE_ROWS`` rows; all are chosen by a hash of the id.  Scoring covers every
whole text.

Defined results: null and empty texts have the feature 0.  With no labelled
rows, or labels of one kind only, the score is the smoothed share of good
labels for every text.  An id that is labelled more than once counts as often.
Very long texts are scored whole, piece by piece.  An empty table gives no
rows.  An extra column named as an output is replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from policylens.llm.common import stage, with_results

PIECE = 2_000
SAMPLE_ROWS = 8_000
DICTIONARY_PIECES = 2_500
DICTIONARY_BYTES = 112_640
LEVEL = 3


def pieces(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    #: of the difference, of the shrinkage beyond the usual, and the offset
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)
    usual: float = 0.0

    def __post_init__(self):
        self._compressors = None

    def __getstate__(self):
        return (self.good, self.bad, self.weights, self.usual)

    def __setstate__(self, state):
        self.good, self.bad, self.weights, self.usual = state
        self._compressors = None

    def feature(self, text: str | None) -> tuple[float, float]:
        """The difference (above 0: the good dictionary helps more), and the log
        of the compressed over the whole size."""
        if not text or not self.good or not self.bad:
            return 0.0, 0.0
        if self._compressors is None:
            self._compressors = [
                zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                                         dict_data=zstandard.ZstdCompressionDict(d)).compress
                for d in (self.good, self.bad)]
        good, bad = self._compressors
        with_good = with_bad = 0
        for piece in pieces(text):
            with_good += len(good(piece))
            with_bad += len(bad(piece))
        whole = len(text.encode("utf-8", "surrogatepass"))
        return (with_bad - with_good) / (with_bad + with_good), math.log((with_bad + with_good) / (2 * whole))


def _sampled(labels: DataFrame, rows: int, salt: str) -> DataFrame:
    """At most ``rows`` labelled ids of each kind of label, by hash."""
    kinds = [labels.where(F.col("label") == kind)
             .orderBy(F.xxhash64(F.lit(salt), "doc_id"), "doc_id").limit(rows) for kind in (0, 1)]
    return kinds[0].unionByName(kinds[1])


def _dictionary(samples: list[bytes]) -> bytes:
    if sum(map(len, samples)) < 20_000 or len(samples) < 10:
        return b"".join(samples)[-DICTIONARY_BYTES:]     # too little to train on: a raw-content dictionary
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 4)
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:                          # samples too alike to choose from
        return b"".join(samples)[-DICTIONARY_BYTES:]


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights of the columns of ``x`` and the offset of a logistic curve, by
    Newton steps with a small ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    ridge = 1e-3 * np.eye(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w.tolist())


def features(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """``docs`` without ``text``, with ``feature`` and ``log_ratio``, which replace columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # two dictionaries of a fixed size
    schema = StructType([StructField("feature", DoubleType()), StructField("log_ratio", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature = shared.value.feature
        for batch in batches:
            found = [feature(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), *[pa.array([f[k] for f in found], pa.float64()) for k in (0, 1)]],
                names=["carried", *schema.names])

    return with_results(docs, run, schema)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> CompressionModel:
    """Learn from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label 0/1) names."""
    labels = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "label")
    # one half of the ids makes the dictionaries, the other the curve
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    own = docs.select("doc_id", "text")
    # at most 2 * sample_rows ids: safe to broadcast
    cut = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))))
    chosen = own.join(F.broadcast(_sampled(labels.where(half), sample_rows, "dictionary")), "doc_id").where(
        F.length("text") > 0).withColumn("_at", cut).select(
        "label", F.substring("text", F.col("_at") * PIECE + 1, F.lit(PIECE)).alias("piece"),
        F.xxhash64("doc_id", "_at").alias("_order"))
    chosen = stage(chosen, "labelled-pieces")
    picked = {kind: [r["piece"].encode("utf-8") for r in chosen.where(F.col("label") == kind)
                     .orderBy("_order", "piece").limit(DICTIONARY_PIECES).collect()] for kind in (0, 1)}
    model = CompressionModel(_dictionary(picked[1]), _dictionary(picked[0]))
    shown = own.join(F.broadcast(_sampled(labels.where(~half), sample_rows, "curve")), "doc_id")
    rows = (features(shown, model).orderBy(F.xxhash64("doc_id"), "feature").limit(2 * sample_rows)
            .select("feature", "log_ratio", "label").collect())
    y = np.array([float(r["label"]) for r in rows])
    if not model.good or not model.bad or len(set(y.tolist())) < 2:
        n = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
        share = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
        model.weights = (0.0, 0.0, math.log(share / (1 - share)))
    else:
        ratio = np.array([r["log_ratio"] for r in rows])
        # what three in four good texts stay above
        model.usual = float(np.quantile(ratio[y == 1], 0.25))
        model.weights = fit_curve(np.column_stack([[r["feature"] for r in rows],
                                                   np.maximum(0.0, model.usual - ratio)]), y)
    return model


def score(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """``docs`` without ``text``, with ``feature``, ``score`` (0 to 1) and ``predicted``,
    which replace columns of these names."""
    difference, shrinkage, offset = model.weights
    beyond = F.greatest(F.lit(0.0), F.lit(model.usual) - F.col("log_ratio"))
    p = 1 / (1 + F.exp(-(F.col("feature") * difference + beyond * shrinkage + offset)))
    return features(docs, model).withColumn("score", p).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
