import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import AWKWARD, awkward

from tidemart.llm import queries, secret_scan

ALLOWED = tuple(re.compile(p) for p in secret_scan.ALLOWED)
RANDOM = "Zq8Lr2Xw9Vt4Bn7Kj3Hp6Ys1Dm5Fc0Ga"
KEY_ID = "AKIA" + "IOSFODNN7ABCDEFG"


def slow_base(text):
    """The base kinds as the contract words them: match all, then drop the short ones."""
    assign = re.compile(
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, secret_scan.KINDS[k]) for a, k, b in sorted(found)]


def base_of(text):
    return [s for s in secret_scan.secret_spans(text, ALLOWED) if s[2] != "entropy"]


def test_query_against_plain_patterns(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.QUERIES["op4_secrets"](spark, sf_dir).collect()}
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        base, row = slow_base(text or ""), rows[doc_id]
        count = Counter(kind for *_, kind in base)
        assert (row.n_assign, row.n_access, row.n_hex) == (count["assign"], count["access"], count["hex"])
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["password", "PassWD", "secret", "toKen", "api_key", "APIKEY", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGHIJKLMNOP1",
     "0123456789abcdef", "deadbeef", "x", "é", "K", "ſecret", "\n", "value1", "-", "\x0b"]), max_size=14))
def test_base_spans_equal_plain_patterns(parts):
    text = "".join(parts)
    assert base_of(text) == slow_base(text)


def test_a_failing_match_uses_up_its_text():
    assert base_of("token:token:abcdefg") == []
    assert base_of("token=a secret=abcdef") == [(8, 21, "assign")]


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab01XYZqrstuv789!", max_size=80))
def test_sliding_windows_equal_each_window_alone(run):
    members, least = frozenset("ab01XYZqrstuv789"), 3.0
    covered = set()
    for at in range(len(run) - secret_scan.WINDOW + 1):
        window = run[at : at + secret_scan.WINDOW]
        if set(window) <= members and entropy(window) >= least:
            covered |= set(range(at, at + secret_scan.WINDOW))
    got = set()
    for start, end in secret_scan.random_spans(run, members, least, 0):
        got |= set(range(start, end))
    assert got == covered


def test_random_strings_are_found_and_words_are_not():
    text = f"see {RANDOM} and {'straßenbahnhaltestelle' * 3} or internationalizationalmethodology"
    assert secret_scan.entropy_spans(text, ALLOWED) == [(4, 4 + len(RANDOM), "entropy")]


def test_allow_list_suppresses_added_spans_only():
    assert secret_scan.entropy_spans(f"EXAMPLE{RANDOM}", ALLOWED) == []
    assert secret_scan.entropy_spans("123e4567-e89b-12d3-a456-426614174000", ALLOWED) == []
    spans = secret_scan.secret_spans(f"secret=EXAMPLE{RANDOM} {KEY_ID}", ALLOWED)
    assert [kind for *_, kind in spans] == ["assign", "access"]


def test_span_inside_a_base_span_adds_nothing():
    assert [k for *_, k in secret_scan.secret_spans(f"token={RANDOM}", ALLOWED)] == ["assign"]


def test_awkward_rows_and_empty_table(spark):
    rows = secret_scan.scan(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD) and all(r.spans == [] for r in rows)
    assert secret_scan.scan(awkward(spark, [])).count() == 0


def test_code_points_not_bytes(spark):
    (row,) = secret_scan.scan(awkward(spark, [(1, f"🙂é {RANDOM}")])).collect()
    assert [tuple(s) for s in row.spans] == [("entropy", 3, 3 + len(RANDOM))]


def found_in(text):
    return [text[a:b] for a, b, _ in secret_scan.entropy_spans(text, ALLOWED)]


def test_allow_list_takes_out_its_match_only():
    token = RANDOM[:24]
    (hook,) = found_in(f"https://hooks.slack.com/services/T0000/B0000/{token}")
    assert hook.endswith(token)
    assert found_in(f"A=B={token}") == [token]
    key = RANDOM + "+" * 14 + RANDOM[::-1]
    assert found_in(key) == [RANDOM, RANDOM[::-1]]
    assert found_in(f"{RANDOM}/example/{RANDOM}") == [RANDOM + "/", "/" + RANDOM]
    assert found_in("sha256-" + RANDOM + RANDOM[:11] + "=") == []


def test_letters_of_one_case_and_short_strings():
    lower, upper = "k3x9q2mz7v4tb8w1hj6pn5rc", "K3X9Q2MZ7V4TB8W1HJ6PN5RC"
    for token in (lower, upper, lower[:20], upper[:16], "Zq8Lr2Xw9Vt4Bn7K", "9f3c07ab51e2d864"):
        assert found_in(f"see {token} here") == [token]
    assert found_in("internationalization2 4556737586899855 Rechtsschutzversicherung getElementsByClassName") == []


ALPHABETS = {
    "letters": string.ascii_letters,
    "lower and digits": string.ascii_lowercase + string.digits,
    "upper and digits": string.ascii_uppercase + string.digits,
    "alphanumeric": string.ascii_letters + string.digits,
    "base 64": string.ascii_letters + string.digits + "+/",
}


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("length", [16, 24, 40])
def test_recall_over_random_strings(alphabet, length):
    rng, found = random.Random(f"{alphabet}{length}"), 0
    patterns = tuple(re.compile(p) for p in secret_scan.ALLOWED)
    for _ in range(400):
        text = "the key is " + "".join(rng.choices(ALPHABETS[alphabet], k=length)) + " as it was"
        found += bool(secret_scan.entropy_spans(text, patterns))
    assert found / 400 >= (0.75 if length == 16 else 0.9)


def test_names_and_prose_are_no_secrets(spark, sf_dir):
    patterns = tuple(re.compile(p) for p in secret_scan.ALLOWED)
    names = "getUserNameFromDatabaseRow AbstractSingletonProxyFactoryBean XMLHttpRequestEventTarget Donaudampfschifffahrtsgesellschaft INTERNATIONALIZATIONSUPPORT"
    assert secret_scan.entropy_spans(names, patterns) == []
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    plain = [t for t in texts if t and not secret_scan.base_spans(t)]
    assert len(plain) > 100 and not any(secret_scan.entropy_spans(t, patterns) for t in plain)
