"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

*Features* of a text: its words (split at ``[\\x20\\x09-\\x0D]+``) hashed, the
words' shapes hashed (letters to ``a``/``A``, digits to ``9``, every run cut to
two) and a mark for a word that repeats the one before.  Weights are
``(1 + ln tf) * idf``, with document frequencies counted over **all**
documents.

*Fit* (on a bounded sample): at most ``max_labelled`` labelled training rows,
those with the smallest hash of their ``doc_id``, give the truncated SVD
(randomised, fixed seed) and the labelled vectors.  Labels never enter another
way, and ``lang``, ``source`` and ``doc_id`` are no features.

*Score*: the SVD basis and the labelled vectors (``max_labelled x rank``
floats at most, whatever the corpus) are broadcast; every document's vector is
multiplied with all of them in blocks (exact cosines, no index), and the ``k``
nearest vote with their similarity to the power ``sharpness``.  Ties in
similarity go to the vector whose ``doc_id`` hash is smaller.

Defined cases: null or empty texts (and any text when no label can be learnt)
score the training share of label 1 (0.5 without labels); a document labelled
several times counts once with its mean label, a mean of a half or more being 1,
and one with several rows is learnt from once, by its smallest text;
labels without a document are ignored; null labels and null ``doc_id`` are not
learnt from; further columns pass through, and result columns get trailing
underscores where the name is taken.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import crc_mod, free_name, table, text_blocks, text_bytes

WORD_DIMS, SHAPE_DIMS = 3072, 1024
DIMS = WORD_DIMS + SHAPE_DIMS
REPEAT = DIMS - 1
#: Remembered words of a Python worker; beyond it the memory starts anew.
REMEMBERED = 200_000

_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 57 if 48 <= c <= 57 else c
               for c in range(256))
_RUN = re.compile(rb"(.)\1\1+", re.S)


def word_features(word: bytes) -> int:
    """Word dimension and shape dimension, packed into one integer."""
    shape = _RUN.sub(rb"\1\1", word.translate(_SHAPE))
    low = xxhash.xxh64_intdigest(word.lower().strip(b".,;:!?\"'()")) % WORD_DIMS
    return low * DIMS + WORD_DIMS + xxhash.xxh64_intdigest(shape) % (SHAPE_DIMS - 1)


class Featurizer:
    def __init__(self):
        self.known: dict[bytes, int] = {}

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Dense (texts x DIMS) feature counts."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, rows, sizes = self.known, [], []
        for t in texts:
            words = t.split()
            for w in set(words):
                if w not in known:
                    known[w] = word_features(w)
            rows.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            sizes.append(len(words))
        flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        again = (flat[1:] == flat[:-1]) & (doc[1:] == doc[:-1])
        at = np.concatenate([doc * DIMS + flat // DIMS, doc * DIMS + flat % DIMS, doc[1:][again] * DIMS + REPEAT])
        return np.bincount(at, minlength=len(texts) * DIMS).reshape(len(texts), DIMS)


def count_blocks(texts: pa.Array, featurizer: Featurizer, rows: int = 128):
    """Feature counts of a column, ``rows`` texts or a block's bytes at a time."""
    for block in text_blocks(texts):
        for lo in range(0, len(block), rows):
            yield featurizer.counts(text_bytes(block.slice(lo, rows)))


def _frequencies(batches):
    """Per task: documents with each feature, and documents."""
    featurizer, seen, n = Featurizer(), np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for counts in count_blocks(batch.column(0), featurizer):
            seen += (counts > 0).sum(axis=0)
            n += len(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1, dtype=np.int32)),
                                      pa.array(np.append(seen, n))], ["dim", "docs"])


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Over all documents: DIMS document frequencies, then their number."""
    parts = docs.select(F.col("text").cast("string")).mapInArrow(_frequencies, "dim int, docs bigint")
    out = np.zeros(DIMS + 1)
    for dim, n in parts.groupBy("dim").agg(F.sum("docs")).collect():
        out[dim] = n
    return out


def _sparse(batches):
    featurizer = Featurizer()
    for batch in batches:
        at = 0
        for counts in count_blocks(batch.column(2), featurizer):
            dims, values = [], []
            for row in counts:
                nz = np.flatnonzero(row)
                dims.append(nz.astype(np.int16))
                values.append(row[nz].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(counts)), batch.column(1).slice(at, len(counts)),
                 pa.array(dims, pa.list_(pa.int16())), pa.array(values, pa.list_(pa.int32()))],
                ["order", "label", "dims", "counts"])
            at += len(counts)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32))
    x *= idf
    return x


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def truncated_svd(x: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """Right singular vectors (features x rank) by a randomised range finder."""
    rng = np.random.default_rng(seed)
    y = x @ rng.standard_normal((x.shape[1], rank + 16)).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(y)
        y = x @ (x.T @ q)
    q, _ = np.linalg.qr(y)
    _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
    return np.ascontiguousarray(vt[:rank].T)


class Neighbours:
    """The fitted model: idf, SVD basis, labelled unit vectors and labels."""

    def __init__(self, idf, basis, vectors, labels, k, sharpness):
        self.idf, self.basis, self.vectors, self.labels = idf, basis, vectors, labels
        self.k, self.sharpness = min(k, len(labels)), sharpness
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(weighted(counts, self.idf) @ self.basis)

    def vote(self, z: np.ndarray) -> np.ndarray:
        """Scores of unit vectors, by exact cosines with all labelled ones."""
        if not self.k:
            return np.full(len(z), self.prior)
        cosine = z @ self.vectors.T
        if self.k < cosine.shape[1]:
            edge = np.partition(cosine, -self.k, axis=1)[:, -self.k, None]
            above = cosine > edge
            level = cosine == edge
            room = self.k - above.sum(axis=1, keepdims=True)
            near = above | (level & (np.cumsum(level, axis=1) <= room))
        else:
            near = np.ones_like(cosine, bool)
        row, col = np.nonzero(near)
        w = np.maximum(cosine[row, col], 0).astype(np.float64) ** self.sharpness
        total = np.bincount(row, w, len(z))
        good = np.bincount(row, w * self.labels[col], len(z))
        return np.divide(good, total, out=np.full(len(z), self.prior), where=total > 0)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_labelled: int = 4096, rank: int = 64, k: int = 15,
        sharpness: float = 4.0) -> Neighbours:
    """Learn from ``labels`` (doc_id, quality) rows for which ``learn`` holds."""
    freq = document_frequencies(docs)
    idf = (np.log((1 + freq[-1]) / (1 + freq[:-1])) + 0.2).astype(np.float32)
    chosen = labels.where(learn & F.col("doc_id").isNotNull() & F.col("quality").isNotNull()) \
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")) \
        .withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(max_labelled)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id") \
        .groupBy("order", "doc_id", "label").agg(F.min("text").alias("text")).select("order", "label", "text")
    rows = sorted(sample.mapInArrow(_sparse, "order bigint, label int, dims array<smallint>, counts array<int>")
                  .collect(), key=lambda r: (r[0], r[2], r[3], r[1]))
    x = np.zeros((len(rows), DIMS), np.float32)
    for i, (_, _, dims, counts) in enumerate(rows):
        x[i, dims] = counts
    y = np.array([r[1] for r in rows], np.float64)
    x = weighted(x, idf)
    if not len(rows):
        return Neighbours(idf, np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), y, 0, sharpness)
    x = unit(x)
    basis = truncated_svd(x, min(rank, len(rows)))
    return Neighbours(idf, basis, unit(x @ basis), y, k, sharpness)


def scorer(model: Neighbours, spark: SparkSession):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m, featurizer = shared.value, Featurizer()
        out = [m.vote(m.project(c)) for c in count_blocks(texts, featurizer)]
        return pa.array(np.concatenate(out) if out else np.empty(0))
    return score


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, **params) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1; higher: label 1 likelier)."""
    model = fit(docs, labels, learn, **params)
    score = scorer(model, docs.sparkSession)
    return docs.withColumn(free_name(docs.columns, "score"), score(F.col("text").cast("string")))


def in_training() -> Column:
    """Rows that labels may be learnt from: crc32(doc_id as text) mod 5 is not 0."""
    return crc_mod("doc_id", 5) != 0


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"), in_training())
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
