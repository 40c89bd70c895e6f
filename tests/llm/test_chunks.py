import hashlib
import random

import numpy as np
import pytest
from llm.helpers import AWKWARD, LONG, awkward, prose

from tidemart.llm import chunks, queries


def expected(rows):
    """The query's rows from all documents in one list; equal ids by text."""
    named = sorted((i, t or "") for i, t in rows if i is not None)
    out = []
    for n, (doc_id, text) in enumerate(named):
        after = named[(n + 1) % len(named)][1]
        tail = len(text) // 4
        out.append((doc_id, text, text[: len(text) - tail] + after[:tail], after))
    out += [(None, t or "", (t or "")[: len(t or "") - len(t or "") // 4], "") for i, t in rows if i is None]
    sets = lambda text: chunks.chunk_set(text.encode())
    return sorted(
        (
            (i, len(t), hashlib.sha256(e.encode()).hexdigest(), chunks.written(sets(t)), chunks.written(sets(e)),
             chunks.containment(sets(t), sets(e)), chunks.containment(sets(t), sets(a)))
            for i, t, e, a in out
        ),
        key=str,
    )


def test_query_against_one_list(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op10_chunks"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


@pytest.mark.parametrize("docs_per_block", [1, 3, 1000])
def test_awkward_rows(spark, docs_per_block):
    got = chunks.likeness(awkward(spark), docs_per_block=docs_per_block).collect()
    assert sorted(map(tuple, got), key=str) == expected(AWKWARD)


def test_empty_table_and_single_row(spark):
    assert chunks.likeness(awkward(spark, [])).count() == 0
    (row,) = chunks.likeness(awkward(spark, [(5, prose(50, 1))])).collect()
    assert row.near_next == 1.0


def test_gear_hash_sums_the_last_sixteen_bytes():
    data = np.frombuffer(prose(20, 2).encode(), np.uint8)
    got = chunks.gear_hashes(data)
    for i in range(len(data)):
        want = sum(int(chunks.GEAR[data[i - d]]) << d for d in range(min(16, i + 1))) % 65536
        assert got[i] == want


def test_chunk_lengths_and_whole_text():
    data = prose(2000, 7).encode()
    ends = chunks.boundaries(data)
    lengths = np.diff([0, *ends])
    assert ends[-1] == len(data) and lengths[:-1].min() >= chunks.LEAST and lengths.max() <= chunks.MOST
    assert chunks.LEAST < lengths.mean() < 2 * chunks.USUAL
    assert chunks.boundaries(b"") == [] and chunks.boundaries(b"x") == [1]


def test_slabs_do_not_matter(monkeypatch):
    data = LONG.encode()
    whole = chunks.boundaries(data)
    monkeypatch.setattr(chunks, "SLAB", 1000)
    assert chunks.boundaries(data) == whole


def test_an_insertion_changes_few_chunks():
    rng, text = random.Random(3), prose(1500, 9)
    for _ in range(20):
        at = rng.randrange(len(text))
        other = text[:at] + "inserted words" + text[at:]
        assert chunks.containment(chunks.chunk_set(text.encode()), chunks.chunk_set(other.encode())) > 0.9


def test_fingerprints_of_equal_texts_are_equal(spark):
    got = chunks.fingerprints(awkward(spark)).collect()
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[7] == prints[8] and prints[3] == prints[4] == {""} and len(prints[9]) == 2
