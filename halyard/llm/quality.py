"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

The statistics come from the whole text in numpy; log and log-odds make them closer to normal. Class sums and
cross products are added up by Spark. Each class covariance is shrunk towards the pooled one and then towards
a multiple of the identity; its Cholesky factor is computed once. A score is the logistic of the difference
of the two Mahalanobis log densities and log priors.

Defined results: an empty or null text has the statistics of no words and is scored by them; a label that is
null, or whose document is missing, isn't learned from; a document with several labels takes the lowest;
without labels of both classes every score is the share of label 1 (0.5 without any); repeated rows each
give their own row; null ids count as the empty id, have no label and are scored; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.llm.shared import blocks, crc_part, packed, word_hashes, words, written

FEATURES = ("word_bytes", "spread", "upper", "symbols", "digits", "bars", "endings", "repeats", "variety", "lines")
TO_POOLED = 0.1
TO_IDENTITY = 0.05
ACCEPT = 0.7
_CLASS = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 bar, 5 other symbol, 6 line end; 0 space and mild punctuation
_CLASS[97:123] = _CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"()-?|"]] = 5
_CLASS[ord("|")] = 4
_CLASS[10] = 6


#: A short text counts as if it had this many more words (or 5 times as many letters) of the usual kind.
PRIOR = 20.0


def _odds(part: np.ndarray, of: np.ndarray, usual: float, weight: float = PRIOR) -> np.ndarray:
    """Log-odds of a share; `usual` is what texts without content have."""
    return np.log((part + weight * usual) / (np.maximum(of - part, 0) + weight * (1 - usual)))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of FEATURES, one a text."""
    n = len(offsets) - 1
    start, end, doc = words(data, offsets)
    hashes = word_hashes(data, start, end)
    count = np.bincount(doc, minlength=n).astype(float)
    size = (end - start).astype(float)
    total = np.bincount(doc, size, n)
    square = np.bincount(doc, size * size, n)
    kind = _CLASS[data]
    per_text = np.zeros((7, n))
    for k in range(1, 7):
        sums = np.append(0, np.cumsum(kind == k))
        per_text[k] = sums[offsets[1:]] - sums[offsets[:-1]]
    letters = per_text[1] + per_text[2]
    odd_end = np.isin(kind[end - 1], (4, 5)) if len(end) else np.zeros(0, bool)
    same = np.zeros(len(doc), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    distinct = np.bincount(d[new], minlength=n)
    # sums that include the prior's words of 5 bytes, give or take 2.5
    mean = (total + PRIOR * 5.0) / (count + PRIOR)
    spread = np.sqrt(np.maximum((square + PRIOR * 31.25) / (count + PRIOR) - mean * mean, 0.01))
    return np.column_stack([
        np.log(mean),
        np.log(spread),
        _odds(per_text[2], letters, 0.03, 5 * PRIOR),
        _odds(per_text[5], total, 0.005, 5 * PRIOR),
        _odds(per_text[3], total, 0.005, 5 * PRIOR),
        _odds(per_text[4], count, 0.005),
        _odds(np.bincount(doc[odd_end], minlength=n), count, 0.005),
        _odds(np.bincount(doc[same], minlength=n), count, 0.01),
        np.log((distinct + PRIOR) / (count + PRIOR)),
        _odds(per_text[6], count, 0.02),
    ])


class Model(NamedTuple):
    share: float  # of label 1
    means: tuple | None  # one vector a class, over standardised statistics
    factors: tuple | None  # inverse Cholesky factors
    offsets: tuple | None  # log prior less half the log determinant
    centre: np.ndarray | None
    scale: np.ndarray | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        z = (x - self.centre) / self.scale
        logs = [o - 0.5 * (((z - m) @ f.T) ** 2).sum(1) for m, f, o in zip(self.means, self.factors, self.offsets, strict=True)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and x, the statistics of each whole text."""

    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            x = statistics(data, offsets)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), flat], ["doc_id", "x"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, x array<double>")


def fit(labelled: DataFrame, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Model:
    """The model of rows (x, label). Only class counts, sums and cross products, of fixed size, reach the driver."""
    d = len(FEATURES)
    first = [F.sum(F.col("x")[i]) for i in range(d)]
    second = [F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(d) for j in range(i, d)]
    found = {r[0]: [float(v) for v in r[1:]] for r in labelled.where("label in (0, 1)").groupBy("label").agg(F.count("*"), *first, *second).collect()}
    n = [found.get(k, [0.0])[0] for k in (0, 1)]
    if not all(n):
        return Model(n[1] / sum(n) if sum(n) else 0.5, None, None, None, None, None)
    sums = [np.array(found[k][1 : d + 1]) for k in (0, 1)]
    cross = []
    for k in (0, 1):
        c = np.zeros((d, d))
        c[np.triu_indices(d)] = found[k][d + 1 :]
        cross.append(c + np.triu(c, 1).T)
    centre = (sums[0] + sums[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(cross[0] + cross[1]) / sum(n) - centre**2, 0)) + 1e-6
    means, scatter = [], []
    for k in (0, 1):
        m = sums[k] / n[k]
        means.append((m - centre) / scale)
        scatter.append((cross[k] - n[k] * np.outer(m, m)) / np.outer(scale, scale))
    pooled = (scatter[0] + scatter[1]) / sum(n)
    factors, offsets = [], []
    for k in (0, 1):
        cov = (1 - to_pooled) * scatter[k] / n[k] + to_pooled * pooled
        cov = (1 - to_identity) * cov + to_identity * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(n[k] / sum(n)) - np.log(np.diag(lower)).sum())
    return Model(n[1] / sum(n), tuple(means), tuple(factors), tuple(offsets), centre, scale)


def _known(labels: DataFrame) -> DataFrame:
    return labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))


def accepted(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that score at least `accept`; a map over rows after the fit."""
    x = written(features(docs.where(crc_part(doc_id, 4) != 2).join(_known(labels).select(F.col("doc_id").alias(doc_id)), doc_id, "left_semi"), doc_id, text))
    model = fit(x.join(_known(labels), "doc_id"))

    def run(batches):
        for part, data, offsets in blocks(batches, "text"):
            yield part.filter(pa.array(model.score(statistics(data, offsets)) >= accept)).select(["row"])

    rows = packed(docs, text=text)
    return rows.mapInArrow(run, T.StructType([rows.schema["row"]])).select("row.*")


def scored(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of each document.

    Learns from the labelled documents whose crc32 of the id isn't 2 modulo 4. The texts are read once:
    their statistics are written to the shared folder, and both steps read those."""
    x = written(features(docs, doc_id, text).withColumn("held_out", crc_part("doc_id", 4) == 2))
    model = fit(x.where("not held_out").join(_known(labels), "doc_id"))

    def run(batches):
        for batch in batches:
            flat = batch.column("x")
            values = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            score = model.score(values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= accept).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return x.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
