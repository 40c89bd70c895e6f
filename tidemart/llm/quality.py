"""Quality classifier: nearest labelled neighbours in a latent-semantic space vote by similarity.

A text's terms are its character trigrams, once by kind of character and once hashed, and marks of
repeated words and lines. Term weights and a truncated singular value decomposition are learned from
a bounded sample of labelled rows; a larger, likewise bounded bank of labelled rows is
projected and broadcast. Every document is projected where it lies, its cosines with the whole bank
are computed exactly, a block of documents at a time, and its nearest neighbours vote.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.tables import stored, utf8

# Labelled rows that the decomposition is fitted on, and those that vote: fixed bounds whatever the
# size of the labels, taken in order of a hash of the id.
FIT_ROWS = 2048
BANK_ROWS = 8192
DIMENSIONS = 64
NEIGHBOURS = 9
THRESHOLD = 0.7
# Documents whose cosines with the bank are held at once.
BLOCK_DOCS = 256

SHAPES, HASHED, MARKS = 16**3, 2048, 3
SLAB = 1 << 20


def _character_kinds() -> np.ndarray:
    """Sixteen kinds of bytes: letters, digits, white space, and the usual punctuation one by one."""
    kinds = np.full(256, 15, np.uint8)
    kinds[0x80:] = 0  # letters beyond ASCII, mostly
    for kind, chars in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r",
         b".", b",;:", b"!?", b"|", b"#", b"*", b"$%&@", b"'\"`", b"()[]{}", b"-_/\\")
    ):
        kinds[list(chars)] = kind
    return kinds


KINDS = _character_kinds()
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def terms(data: bytes) -> np.ndarray:
    """The term vector of a text: square roots of relative frequencies, zero for an empty text."""
    counts = np.zeros(SHAPES + HASHED, np.int64)
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, max(0, len(raw) - 2), SLAB):
        part = raw[at : at + SLAB + 2]
        kinds = KINDS[part].astype(np.int64)
        counts[:SHAPES] += np.bincount((kinds[:-2] << 8) + (kinds[1:-1] << 4) + kinds[2:], minlength=SHAPES)
        low = LOWER[part].astype(np.uint32)
        mixed = low[:-2] * np.uint32(0x9E3779B1) ^ low[1:-1] * np.uint32(0x85EBCA77)
        mixed ^= low[2:] * np.uint32(0xC2B2AE3D)
        counts[SHAPES:] += np.bincount(mixed >> np.uint32(21), minlength=HASHED)
    vector = np.zeros(SHAPES + HASHED + MARKS, np.float32)
    total = counts[:SHAPES].sum()
    if total:
        vector[:-MARKS] = np.sqrt(counts / total)
    words = data.split()
    if words:
        again = sum(a == b for a, b in zip(words, words[1:], strict=False))
        lines = data.split(b"\n")
        shares = again, len(words) - len(set(words)), len(lines) - len(set(lines))
        vector[-MARKS:] = np.sqrt(np.array(shares) / (len(words), len(words), len(lines)))
    return vector


@dataclass
class Space:
    """Term weights, the mean of the weighted sample, and its leading directions."""

    weights: np.ndarray
    mean: np.ndarray
    directions: np.ndarray

    @classmethod
    def fitted(cls, sample: np.ndarray, dimensions: int) -> Space:
        """The latent space of sampled term vectors, by the eigenvectors of their products."""
        weights = (np.log((1 + len(sample)) / (1 + (sample > 0).sum(axis=0))) + 1).astype(np.float32)
        weighted = sample * weights
        mean = weighted.mean(axis=0)
        weighted -= mean
        values, vectors = np.linalg.eigh(weighted @ weighted.T)
        lead = values > max(values[-1], 0) * 1e-6
        lead[: max(0, len(values) - dimensions)] = False
        directions = weighted.T @ (vectors[:, lead] / np.sqrt(values[lead])).astype(np.float32)
        return cls(weights, mean, directions)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Latent vectors of length one."""
        latent = (vectors * self.weights - self.mean) @ self.directions
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)


def vote(latent: np.ndarray, bank: np.ndarray, labels: np.ndarray, neighbours: int) -> np.ndarray:
    """The mean label of each row's nearest bank rows, weighted by cosine; negative cosines count nothing."""
    cosines = latent @ bank.T
    k = min(neighbours, len(bank))
    if k < len(bank):
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    else:
        nearest = np.arange(k)[None].repeat(len(latent), axis=0)
    weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0) + 1e-9
    return np.clip((weights * labels[nearest]).sum(axis=1) / weights.sum(axis=1), 0, 1)


def is_held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _bank_rows(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, size: int):
    """``(doc_id, data, label)``: the texts of up to ``size`` labelled ids, one row each."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~is_held_out(id_col))
        .groupBy(F.col(id_col).cast("long").alias("bank_id"))
        .agg(F.avg(F.col(label_col).cast("double")).alias("label"))
        .orderBy(F.xxhash64("bank_id"), "bank_id")
        .limit(size)
    )
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # At most ``size`` ids and labels are broadcast.
    chosen = texts.join(F.broadcast(known), F.col("doc_id") == F.col("bank_id"))
    one_each = chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return one_each.select("doc_id", utf8("text").alias("data"), "label")


def _fit(dimensions: int):
    """A task that fits the space to all its rows and returns it as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [terms(data) for batch in batches for data in batch.column("data").to_pylist()]
        if sample:
            space = Space.fitted(np.stack(sample), dimensions)
            parts = space.weights, space.mean, space.directions
            arrays = [pa.array([part.astype(np.float32).tobytes()], pa.binary()) for part in parts]
            yield pa.RecordBatch.from_arrays(arrays, ["weights", "mean", "directions"])

    return run


def _project(space: Space):
    """A task that returns the latent vector of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            latent = (space.project(terms(data)[None]) for data in batch.column("data").to_pylist())
            vectors = pa.array([v.astype(np.float32).tobytes() for v in latent], pa.binary())
            columns = [batch.column("doc_id"), vectors, batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "vector", "label"])

    return run


@dataclass
class Classifier:
    """A latent space and the labelled vectors that vote in it."""

    space: Space
    bank: np.ndarray
    labels: np.ndarray
    neighbours: int

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Scores from 0 to 1, higher where label 1 is likelier; 1 if there is no labelled row at all."""
        if not len(self.bank):
            return np.ones(len(texts))
        found = []
        for at in range(0, len(texts), BLOCK_DOCS):
            latent = self.space.project(np.stack([terms(data) for data in texts[at : at + BLOCK_DOCS]]))
            found.append(vote(latent, self.bank, self.labels, self.neighbours))
        return np.concatenate(found) if found else np.zeros(0)


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    bank_rows: int = BANK_ROWS,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> Classifier:
    """A classifier from labelled rows that are not held out.

    One task fits the space to ``fit_rows`` rows; ``bank_rows`` latent vectors at most reach the
    driver, whatever the size of the tables. Null labels and ids are left out, several labels of an
    id averaged; of rows that repeat an id the least text is taken.
    """
    bank = stored(_bank_rows(documents, labels, id_col, text_col, label_col, bank_rows), "bank")
    sample = bank.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    fitted = sample.mapInArrow(_fit(dimensions), "weights binary, mean binary, directions binary").first()
    if fitted is None:
        empty = np.zeros((0, 0), np.float32)
        return Classifier(Space(empty, empty, empty), empty, empty, neighbours)
    weights, mean, directions = (np.frombuffer(part, np.float32) for part in fitted)
    space = Space(weights, mean, directions.reshape(len(weights), -1))
    projected = bank.mapInArrow(_project(space), "doc_id long, vector binary, label double")
    rows = sorted(projected.collect(), key=lambda r: r.doc_id)
    vectors = np.stack([np.frombuffer(r.vector, np.float32) for r in rows])
    return Classifier(space, vectors, np.array([r.label for r in rows]), neighbours)


def _sent(spark: SparkSession, classifier: Classifier) -> Callable[[], Classifier]:
    """The classifier as tasks get it: its arrays, whose size is fixed, are broadcast."""
    space = classifier.space
    arrays = space.weights, space.mean, space.directions, classifier.bank, classifier.labels
    sent, neighbours = spark.sparkContext.broadcast(arrays), classifier.neighbours

    def received() -> Classifier:
        weights, mean, directions, bank, labels = sent.value
        return Classifier(Space(weights, mean, directions), bank, labels, neighbours)

    return received


def _parts(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Small batches, each with its texts as bytes; ``place`` is the text's column."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_DOCS):
            part = batch.slice(at, BLOCK_DOCS)
            yield part, [(text or "").encode() for text in part.column(place).to_pylist()]


def scored(
    documents: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, score)``, one row per input row; null texts count as empty. Other columns are ignored."""
    received = _sent(documents.sparkSession, classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = received()
        for part, texts in _parts(batches, 1):
            scores = pa.array(voters.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0), scores], ["doc_id", "score"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def accepted(
    documents: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns.

    Without any labelled row nothing is rejected; an empty table stays empty.
    """
    classifier = train(documents, labels, text_col=text_col)
    received, place = _sent(documents.sparkSession, classifier), documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = received()
        for part, texts in _parts(batches, place):
            yield part.filter(pa.array(voters.scores(texts) >= threshold))

    return documents.mapInArrow(run, documents.schema)
