import zlib

import numpy as np
from llm.helpers import AWKWARD, awkward, prose

from tidemart.llm import quality, queries

LABELLED = 120


def corpus(spark):
    """Prose, labelled 1, and shouting with signs, labelled 0; ids from 1000 on are not labelled."""
    rows = []
    for n in range(2 * LABELLED):
        doc_id = n if n < LABELLED else 1000 + n
        rows.append((doc_id, prose(60, n) if n % 3 else prose(60, n).upper().replace(" ", "!! *** ")))
    labels = [(n, int(n % 3 > 0)) for n in range(LABELLED)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_unlabelled_rows(spark):
    documents, labels = corpus(spark)
    classifier = quality.train(documents, labels)
    rows = quality.scored(documents.where("doc_id >= 1000"), classifier).collect()
    assert len(rows) == LABELLED
    assert all((r.score >= 0.7) == ((r.doc_id - 1000) % 3 > 0) for r in rows)


def test_held_out_accuracy(spark):
    """On the rows of the query whose labels were not learned from."""
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op7_quality"](spark, sf_dir).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert {i for i, r in rows.items() if r.held_out} == {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    held = [i for i in labels if i in rows and rows[i].held_out]
    right = sum(rows[i].predicted == labels[i] for i in held)
    assert len(held) > 50 and right / len(held) > 0.95


def test_held_out_labels_are_not_learned(spark):
    documents, labels = corpus(spark)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    a, b = (quality.train(documents, x) for x in (labels, flipped))
    assert np.array_equal(a.labels, b.labels) and np.array_equal(a.bank, b.bank)


def test_blocked_votes_equal_a_plain_loop():
    rng = np.random.default_rng(4)
    unit = lambda n: (x := rng.normal(size=(n, 8))) / np.linalg.norm(x, axis=1, keepdims=True)
    latent, bank, labels = unit(20), unit(50), rng.integers(0, 2, 50).astype(float)
    got = quality.vote(latent, bank, labels, 7)
    for row, score in zip(latent, got, strict=True):
        near = sorted(range(50), key=lambda i: -(row @ bank[i]))[:7]
        weights = [max(0.0, row @ bank[i]) + 1e-9 for i in near]
        assert abs(score - np.dot(weights, labels[near]) / sum(weights)) < 1e-9


def test_bounds_on_what_reaches_the_driver(spark):
    documents, labels = corpus(spark)
    classifier = quality.train(documents, labels, fit_rows=20, bank_rows=30, dimensions=5)
    assert len(classifier.bank) <= 30 and classifier.space.directions.shape[1] <= 5


def test_awkward_rows(spark):
    documents, _ = corpus(spark)
    frame = awkward(spark).unionByName(documents, allowMissingColumns=True)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 1), (9, 1), (77, 0), (12345, 1)], "doc_id long, quality int"
    )
    kept = quality.accepted(frame, labels, threshold=0.0)
    assert kept.columns == frame.columns and kept.count() == len(AWKWARD) + 2 * LABELLED


def test_nothing_is_rejected_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.accepted(awkward(spark), none).count() == len(AWKWARD)
    assert quality.accepted(awkward(spark, []), none).count() == 0


def test_terms_of_a_long_text_in_slabs(monkeypatch):
    data = prose(3000, 8).encode()
    whole = quality.terms(data)
    monkeypatch.setattr(quality, "SLAB", 97)
    assert np.array_equal(quality.terms(data), whole)
    assert not quality.terms(b"").any()
