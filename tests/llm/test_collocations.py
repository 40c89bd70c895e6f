import re
from collections import Counter

import pytest
from llm.helpers import AWKWARD, LONG, WORDS, awkward, prose
from parity import compare, connect

from tidemart.llm import collocations, queries

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """All phrases of one to four words by (lang, words)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts["und" if lang is None else lang, tuple(words[i : i + n])] += 1
    return counts, totals


def expected(rows, least=30, top=2000):
    counts, totals = counted(rows)
    candidates = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    dropped = set()
    for (lang, words), n in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = lang, words[i : i + size]
                if 100 * n >= 80 * counts[inner]:
                    dropped.add(inner)
    out = {}
    for (lang, words), a in candidates.items():
        if (lang, words) in dropped:
            continue
        sides = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(sides))  # noqa: E741
        phrase = " ".join(words)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, a, l, r, totals[lang], score))
    return sorted((lang, i, *row[3:]) for lang, found in out.items() for i, row in enumerate(sorted(found)[:top], 1))


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "lang string, text string, phrase string, n string")


def test_query_against_sql(spark, sf_dir):
    con = connect(sf_dir)
    got = queries.QUERIES["op13_collocations"](spark, sf_dir)
    assert compare(got, con, queries.ORACLE_SQL["op13_collocations"]) == []


def test_query_against_counters(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    got = rows_of(queries.QUERIES["op13_collocations"](spark, sf_dir))
    assert got == expected([tuple(r) for r in table.collect()]) and len(got) >= 50


ROWS = [("en", "The quick, the quick\tbrown FOX the\x01 quick  brown fox? a b a b a b a b\r\na b")] * 9
ROWS += [("de", "ÄÖ äö ÄÖ äö. " * 20), (None, "a b c d " * 30), ("und", "a b c"), ("en", None), (None, None), ("en", "")]
ROWS += [("fr", LONG), ("fr", LONG), ("fr", " ".join(WORDS) * 40), ("", "a b"), ("en", " \t. ,"), ("en", "solo")]


@pytest.mark.parametrize("budget, chunk", [(400_000, 1 << 24), (4_000, 1 << 24), (20_000, 50)])
def test_awkward_texts(spark, budget, chunk):
    """The groups, extended prefixes and chunks change nothing."""
    got = rows_of(collocations.collocations(table(spark, ROWS), least=5, top=40, budget=budget, chunk=chunk))
    assert got == expected(ROWS, 5, 40)


def test_awkward_rows(spark):
    documents = awkward(spark).selectExpr("*", "cast(null as string) as lang")
    assert rows_of(collocations.collocations(documents, least=3)) == expected([(None, t) for _, t in AWKWARD], 3)


def test_empty_table(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [("en", None)])).count() == 0


def test_products_beyond_64_bits(spark):
    big = 9 * 10**18
    words = spark.createDataFrame([("en", w, big) for w in "ab"] + [("en", None, big)], "lang string, word string, n long")
    phrases = spark.createDataFrame([("en", "a b", 2, big - 1)], "lang string, phrase string, words int, n long")
    (row,) = collocations.scored(words, phrases).collect()
    assert row.score == 2_000_000 * (big - 1) // (2 * big)
    assert collocations.uncovered(phrases, collocations.scored(words, phrases)).count() == 1


def test_cut_keeps_pieces_whole():
    data = b"aa bb\ncc dd ee ff gg\nhh\n\nii"
    for size in range(1, 30):
        parts = list(collocations._cut(data, size))
        assert b"\n".join(parts) == data


def test_filter_holds_what_was_put_in(spark):
    import numpy as np

    keys = [prose(3, n).__hash__() for n in range(500)] + [-1, 0, 2**63 - 1, -(2**63)]
    small = collocations.BitFilter(collocations.filter_words(spark.createDataFrame([(k,) for k in keys], "key long"), bits=12))
    assert small.has(np.array(keys, np.int64).view(np.uint64)).all()
    none = collocations.BitFilter(collocations.filter_words(spark.createDataFrame([], "key long"), bits=12))
    assert not none.has(np.array([5], np.uint64)).any()
