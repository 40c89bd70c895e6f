import re
from collections import Counter
from itertools import permutations

import pytest
from llm.helpers import AWKWARD, LONG, awkward, prose
from parity import compare, connect

from tidemart.llm import filter_audit, queries


def failed(rows):
    """The letters that each (id, text) fails, said plainly."""
    firsts = {}
    for doc_id, text in rows:
        if doc_id is not None:
            firsts[text or ""] = min(firsts.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append(
            "A" * (len(words) < 200)
            + "B" * (100 * len(set(words)) < 50 * len(words))
            + "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text))
            + "D" * bool(re.search(r"[#$%&*|]", text))
            + "E" * (doc_id is not None and firsts[text] < doc_id)
        )
    return out


def expected(rows, parts, good=(), toxic=()):
    """Every order walked document by document."""
    fails, out, shares = failed(rows), {}, Counter()
    parts = [p or "" for p in parts]
    for order in map("".join, permutations("ABCDE")):
        left = set(range(len(rows)))
        for step, letter in enumerate(order, 1):
            hit = {i for i in range(len(rows)) if letter in fails[i]}
            gone, left_after = left & hit, left - hit
            for part in set(parts):
                here = {i for i in range(len(rows)) if parts[i] == part}
                lost = [rows[i][0] for i in gone & here]
                shares[part, letter] += len(lost)
                out[part, order, step] = [
                    len(left_after & here), len(lost), len((hit - left) & here),
                    sum(fails[i] == letter for i in here),
                    sum(i in good for i in lost), sum(i in toxic for i in lost),
                ]
            left = left_after
    return {key: (*counts, shares[key[0], key[1][key[2] - 1]]) for key, counts in out.items()}


def as_dict(frame):
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in frame.collect()}


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part string")


def test_query_against_sql(spark, sf_dir):
    con = connect(sf_dir)
    got = queries.QUERIES["op12_filter_audit"](spark, sf_dir)
    assert compare(got, con, queries.ORACLE_SQL["op12_filter_audit"]) == []


def test_awkward_rows(spark):
    loud = [(20, "LOUD $ " * 300), (21, "LOUD $ " * 300), (22, "a #"), (23, "\x0b \x0c"), (24, "  ")]
    rows = [*AWKWARD, *loud, (None, LONG)]
    parts = [None if i % 4 == 0 else "en" if i % 4 < 3 else "" for i in range(len(rows))]
    schema = "doc_id long, text string, lang string, mask string, n string, h1 string"
    documents = spark.createDataFrame([(*r, p, "x", "y", "z") for r, p in zip(rows, parts, strict=True)], schema)
    marks = labels(spark, [(1, 1, 0, "q"), (1, 0, 1, "q"), (7, 1, None, "q"), (9, None, 1, "q"), (None, 1, 1, "q"), (99, 1, 1, "q")])
    got = as_dict(filter_audit.audit_documents(documents, marks))
    assert got == expected(rows, parts, good={1, 7}, toxic={1, 9})
    assert len(got) == 2 * 600


def test_hot_copies_are_one_text(spark):
    rows = [(i, prose(250, 3)) for i in range(500)] + [(1000 + i, prose(250, i + 4)) for i in range(20)]
    documents = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    got = as_dict(filter_audit.audit_documents(documents, labels(spark, [])))
    assert got == expected(rows, ["en"] * len(rows))


def test_empty_tables(spark):
    documents = awkward(spark, []).selectExpr("*", "'en' as lang")
    assert filter_audit.audit_documents(documents, labels(spark, [])).count() == 0
    documents = awkward(spark, [(1, None)]).selectExpr("*", "cast(null as string) as lang")
    got = as_dict(filter_audit.audit_documents(documents, labels(spark, [])))
    assert got == expected([(1, None)], [None])


def test_other_filters(spark):
    cells = spark.createDataFrame([("p", 3, 5, 2, 1), ("p", 0, 7, 0, 0)], "part string, mask int, n long, good long, toxic long")
    got = as_dict(filter_audit.audit(cells, "XY"))
    assert got == {
        ("p", "XY", 1): (7, 5, 0, 0, 2, 1, 5),
        ("p", "XY", 2): (7, 0, 5, 0, 0, 0, 5),
        ("p", "YX", 1): (7, 5, 0, 0, 2, 1, 5),
        ("p", "YX", 2): (7, 0, 5, 0, 0, 0, 5),
    }
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "ABCDEFG")
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "AA")
