import random

import numpy as np
import xxhash
from llm.helpers import AWKWARD, awkward, prose
from pyspark.sql import functions as F

from tidemart.llm import queries, simhash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def slow_components(fingerprints):
    """Index of the component of each fingerprint, comparing all pairs."""
    root = list(range(len(fingerprints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    values = np.array(fingerprints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def expected(rows):
    fps = [slow_fingerprint(text) for _, text in rows]
    roots, least = slow_components(fps), {}
    for (doc_id, _), root in zip(rows, roots, strict=True):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted(
        ((i, f"{fp:016x}", least.get(r)) for (i, _), fp, r in zip(rows, fps, roots, strict=True)), key=str
    )


def found(frame):
    named = frame.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")
    return sorted(map(tuple, named.collect()), key=str)


def test_query_against_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op1_simhash"](spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_awkward_rows(spark):
    assert found(simhash.near_duplicates(awkward(spark))) == expected(AWKWARD)


def test_empty_table(spark):
    assert simhash.near_duplicates(awkward(spark, [])).count() == 0


def test_links_of_crowded_cells_lose_nothing_and_are_few(spark):
    random.seed(1)
    values = set()
    for base in (random.getrandbits(64) for _ in range(30)):
        for _ in range(60):
            flips = sum(1 << b for b in random.sample(range(64), random.randint(0, 4)))
            values.add(base ^ flips)
    values = sorted(values)
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    links = simhash.near_links(fps, block=8).collect()
    roots = slow_components(values)
    place = {int(np.uint64(v).view(np.int64)): i for i, v in enumerate(values)}
    joined = list(range(len(values)))

    def find(i):
        while joined[i] != i:
            i = joined[i]
        return i

    for a, b in links:
        joined[find(place[a])] = find(place[b])
    by_root, by_join = {}, {}
    for i in range(len(values)):
        by_root.setdefault(roots[i], set()).add(i)
        by_join.setdefault(find(i), set()).add(i)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_join.values()))


def test_forest_of_a_group_is_linear():
    fps = np.arange(8, dtype=np.int64).repeat(1)
    cells, sides = np.zeros(8, np.int64), np.full(8, -1)
    a, b = simhash.link_sorted(cells, sides, fps, 3)
    assert len(a) == len(b) == 7


def test_manhattan_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    x, y = rng.integers(-(2**63), 2**63 - 1, (2, 500), dtype=np.int64)
    distance = np.abs(simhash.embedding(x) - simhash.embedding(y)).sum(axis=1)
    assert (distance <= np.bitwise_count((x ^ y).view(np.uint64))).all()


def test_long_text_in_blocks_equals_whole():
    text = prose(5000, 3)
    whole = simhash.fingerprint(text.encode())
    blocks, simhash.BYTES_AT_ONCE = simhash.BYTES_AT_ONCE, 100
    try:
        assert simhash.fingerprint(text.encode()) == whole
    finally:
        simhash.BYTES_AT_ONCE = blocks


def test_one_of_each_group_stays(spark):
    kept = simhash.one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    # 4 and 5 are empty like 3; 8 is a copy of 7. All rows of 9 stay.
    assert ids == [1, 2, 3, 6, 7, 9, 9, 9, 10]
    assert kept.where(F.col("doc_id").isNull()).count() == 2


def test_copies_collapse_before_the_grids(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(prose(30)).alias("text"))
    classes = simhash.near_duplicates(many)
    assert classes.agg(F.min("component_id"), F.max("component_id"), F.count("*")).first()[:] == (0, 0, 3000)
