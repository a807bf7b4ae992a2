"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text is a histogram of its byte pairs, hashed to a fixed number of bins, and of
the bytes in words that repeat the word before; it is dampened, weighted by inverse document frequency and projected on the leading
singular vectors of a bounded sample of labelled texts. The sample's vectors and
labels go to every task; each document is compared with all of them by blocks of
cosine products, and its nearest neighbours vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlake.llm.common import encoded, free_names, saved

BINS = 1024
DIMENSIONS = 64
SAMPLE = 3000
NEIGHBOURS = 31
THRESHOLD = 0.3
FOLDS = 5
SHARPNESS = 8.0

_BLOCK = 512
_CHUNK = 1 << 20
# Any odd multiplier spreads byte pairs over the bins.
_BIN_OF = ((np.arange(1 << 16, dtype=np.uint32) * np.uint32(2654435761)) >> np.uint32(22)).astype(np.int64) % BINS


@dataclass(frozen=True)
class Model:
    """What scoring needs; its size depends on the parameters only."""

    weight: np.ndarray  # of each bin
    axes: np.ndarray  # counts x dimensions
    vectors: np.ndarray  # sample x dimensions, of length one or zero
    labels: np.ndarray  # of the sample, 0.0 or 1.0
    prior: float


def histogram(text: bytes) -> np.ndarray:
    """Counts of hashed byte pairs of a whole text, by chunks, and of repeating bytes."""
    counts = np.zeros(BINS + 1, np.int64)
    data = np.frombuffer(text, np.uint8)
    for start in range(0, max(len(data) - 1, 0), _CHUNK):
        part = data[start : start + _CHUNK + 1].astype(np.int64)
        counts[:BINS] += np.bincount(_BIN_OF[part[:-1] << 8 | part[1:]], minlength=BINS)
    words = text.split()
    counts[BINS] = sum(len(word) for word, before in zip(words[1:], words) if word == before)
    return counts


def _dampened(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares: a long text weighs as much as a short one."""
    return np.sqrt(counts / np.maximum(counts.sum(-1, keepdims=True), 1)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def fit(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """A model of sample histograms (one row each) and their labels."""
    rows = _dampened(counts).astype(np.float64)
    weight = np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 1
    rows *= weight
    values, axes = np.linalg.eigh(rows.T @ rows)
    axes = axes[:, np.argsort(-values, kind="stable")[:dimensions]]
    prior = float(labels.mean()) if len(labels) else 0.5
    return Model(weight.astype(np.float32), axes.astype(np.float32), _unit(rows @ axes).astype(np.float32), labels.astype(np.float64), prior)


def vote(model: Model, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores from 0 to 1 of histograms. Neighbours that tie with the last one vote too;
    a text like no labelled one (an empty one) gets the share of label 1 in the sample."""
    scores = np.full(len(counts), model.prior)
    if not len(model.labels):
        return scores
    vectors = _unit((_dampened(counts) * model.weight) @ model.axes).astype(np.float32)
    take = min(neighbours, len(model.labels))
    for start in range(0, len(vectors), _BLOCK):
        cosine = np.round(vectors[start : start + _BLOCK] @ model.vectors.T, 5)
        last = np.partition(cosine, -take, axis=1)[:, -take]
        weights = np.where(cosine >= np.maximum(last, 1e-5)[:, None], np.maximum(cosine, 0), 0).astype(np.float64) ** SHARPNESS
        total = weights.sum(1)
        voted = weights @ model.labels / np.where(total > 0, total, 1)
        scores[start : start + _BLOCK] = np.where(total > 0, voted, model.prior)
    return scores


def _remainder(doc_id) -> object:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most `sample` labelled documents, chosen by a hash of doc_id.

    Labels come from rows of fold other than 0 with a quality of 0 or 1. Of a
    doc_id that is labelled twice, the smaller label counts.
    """
    wanted = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (_remainder(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").alias("quality"))
    )
    present = docs.where("doc_id IS NOT NULL").select("doc_id").distinct()
    order = F.xxhash64("labelled")
    chosen = wanted.join(present, F.col("labelled") == F.col("doc_id"), "left_semi").orderBy(order, "labelled").limit(sample)
    chosen = F.broadcast(saved(chosen, "quality-sample"))

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [histogram(text).astype("<i4").tobytes() for text in encoded(batch["text"])]
            yield pd.DataFrame({"labelled": batch["labelled"], "quality": batch["quality"], "counts": counts})

    found = docs.join(chosen, docs["doc_id"] == chosen["labelled"]).select("labelled", "quality", docs["text"])
    rows = found.mapInPandas(of_batches, "labelled long, quality int, counts binary")
    one = rows.groupBy("labelled").agg(F.min(F.struct("counts", "quality")).alias("row"))  # of rows that share a doc_id
    collected = sorted(one.select("labelled", "row.*").collect(), key=lambda row: row.labelled)
    counts = np.array([np.frombuffer(row.counts, "<i4") for row in collected], np.int32).reshape(-1, BINS + 1)
    return fit(counts, np.array([row.quality for row in collected], np.float64))


def scores(docs: DataFrame, model: Model):
    """A column function: the score of a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # One text at a time is held as bytes; of the others there are histograms.
            found, counts = [np.empty(0)], []
            for text in texts:
                counts.append(histogram(b"" if text is None else text.encode()))
                if len(counts) == _BLOCK:
                    found.append(vote(shared.value, np.array(counts)))
                    counts = []
            if counts:
                found.append(vote(shared.value, np.array(counts)))
            yield pd.Series(np.concatenate(found))

    of_batches.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of_batches, "double")


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs.

    Null and empty texts get the share of good labels; so does every text if there
    are no labels. Repeated rows get the same score. Only doc_id and text of docs
    and doc_id and quality of labels are looked at.
    """
    texts = docs.select("doc_id", "text")
    scored = texts.select("doc_id", scores(docs, train(texts, labels, sample))("text").alias("score"))
    return scored.select(
        "doc_id",
        (_remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs without those the classifier rejects, with their columns.

    Null and empty texts have the share of good labels as their score, like all texts if
    there are no labels, and stay if it reaches the threshold. Rows that repeat stay or go
    together; an empty table gives no rows; columns may have any names.
    """
    model = train(docs.select("doc_id", "text"), labels, sample)
    (name,) = free_names(docs, "score")
    return docs.withColumn(name, scores(docs, model)("text")).where(F.col(name) >= THRESHOLD).drop(name)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
