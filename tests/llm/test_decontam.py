import random

import numpy as np
import pytest
from llm.helpers import awkward, prose

from tidemart.llm import decontam, queries

ITEMS = [(1, prose(40, 3)), (2, prose(60, 4)), (3, "short"), (4, None), (5, prose(12, 6))]


def plain(text):
    """Lower-case words with single spaces, character by character."""
    folded = "".join(c.lower() if c.isalnum() and len(c.lower()) == 1 else c if c.isalnum() else " " for c in text)
    return " ".join(folded.split(" ")).strip(" ") if not folded.strip(" ") else " ".join(folded.split())


def distance_of_best_part(window, text):
    """Least edits between a window and any part of a text, over the whole table."""
    row = np.zeros(len(text) + 1, int)
    chars = np.array([ord(c) for c in text])
    steps = np.arange(len(text) + 1)
    for c in window:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (chars != ord(c)))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def slow_leaks(rows, items, window=decontam.WINDOW, edits=decontam.EDITS):
    found = set()
    for doc_id, text in rows:
        for item_id, item in items:
            norm = plain(item or "")
            if len(norm) < decontam.SHORTEST_ITEM or not text:
                continue
            width = min(window, len(norm))
            budget = width * edits // window
            parts = {norm[i : i + width] for i in range(len(norm) - width + 1)}
            if any(distance_of_best_part(p, plain(text)) <= budget for p in parts):
                found.add((doc_id, item_id))
    return found


def searched(spark, rows, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return decontam.leaks(awkward(spark, rows), benchmark, **options)


def pairs(frame):
    return {(r.doc_id, r.item_id) for r in frame.collect()}


def edited(text, n, rng):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyz")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz"))
    return "".join(chars)


def test_query_against_whole_alignment_of_exact_leaks(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = queries.QUERIES["op5_decontamination"](spark, sf_dir).collect()
    exact = {(d, i) for d, t in docs for i, x in items if plain(x) in plain(t or "")}
    assert {(r.doc_id, r.item_id) for r in rows} >= exact
    texts = dict(docs)
    # Every row shows a place in the whole text that is as near as it says.
    for r in rows:
        part, item = plain(texts[r.doc_id][r.start : r.end]), plain(dict(items)[r.item_id])
        width = min(decontam.WINDOW, len(item))
        assert min(distance_of_best_part(item[i : i + width], part) for i in range(len(item) - width + 1)) <= decontam.EDITS


def test_noisy_passages_against_whole_alignment(spark):
    rng, rows = random.Random(5), []
    for n in range(60):
        item = ITEMS[n % 2][1]
        part = item[rng.randrange(40) : rng.randrange(100, len(item))]
        rows.append((n, prose(20, 30 + n) + " " + edited(part, rng.randrange(0, 26), rng) + " " + prose(15, 60 + n)))
    want = slow_leaks(rows, ITEMS[:2])
    assert 15 < len(want) < 60
    assert pairs(searched(spark, rows, ITEMS[:2])) == want


def test_case_and_punctuation_do_not_matter(spark):
    text = ITEMS[0][1].upper().replace(" ", ",\n  -- ")
    (row,) = searched(spark, [(7, f"before, {text}! after")], ITEMS).collect()
    assert (row.doc_id, row.item_id, row.edits) == (7, 1, 0)
    assert 8 <= row.start < row.end <= 8 + len(text)


def test_long_text_is_read_in_slabs(spark):
    item = ITEMS[1][1]
    rows = [(1, prose(30_000, 9) + " " + item), (2, prose(100, 8) + "\n" * 3000 + item + " !" * 3000 + prose(50, 8)), (3, prose(30_000, 9))]
    assert pairs(searched(spark, rows, ITEMS)) == {(1, 2), (2, 2)}


@pytest.mark.parametrize("slab", [60, 200, 1000])
def test_slabs_lose_nothing_at_their_ends(slab, monkeypatch):
    items = decontam.Items(ITEMS[:2], decontam.WINDOW, decontam.EDITS, decontam.SHORTEST_ITEM)
    monkeypatch.setattr(decontam, "SLAB", slab)
    for shift in range(0, 90, 7):
        found = decontam.Slab(items)
        found.add(0, "x" * shift + " " + ITEMS[0][1] + " " + prose(30, 20))
        found.add(1, prose(50, 21))
        found.flush()
        assert set(found.found) == {(0, 0)}


def test_texts_that_share_very_many_grams(monkeypatch):
    """Repetitive items and texts: halves are searched, and nothing in them is missed."""
    items = [(1, "again and " * 30), (2, prose(60, 4))]
    text = prose(40, 1) + " " + "again and " * 400 + items[1][1] + " again and" * 300
    found = []
    for most in (decontam.MOST_HITS, 1000):
        monkeypatch.setattr(decontam, "MOST_HITS", most)
        slab = decontam.Slab(decontam.Items(items, decontam.WINDOW, decontam.EDITS, decontam.SHORTEST_ITEM))
        slab.add(0, text)
        slab.flush()
        found.append({key: edits for key, (edits, *_) in slab.found.items()})
    assert found[0] == found[1] == {(0, 0): 0, (0, 1): 0}


def test_passage_across_two_documents_is_none(spark):
    half = len(ITEMS[0][1]) // 2
    middle = ITEMS[0][1][half - 60 : half + 60]
    assert pairs(searched(spark, [(1, middle[:60]), (2, middle[60:])], ITEMS)) == set()


def test_items_in_several_blocks(spark):
    rows = [(1, f"{ITEMS[0][1]} and {ITEMS[1][1]}"), (2, ITEMS[4][1] + " end")]
    whole, blocks = (pairs(searched(spark, rows, ITEMS, **o)) for o in ({}, {"block_chars": 150}))
    assert whole == blocks == {(1, 1), (1, 2), (2, 5)}


def test_awkward_rows(spark):
    leak = ITEMS[0][1]
    rows = [(1, None), (2, ""), (3, leak), (3, leak), (3, "clean"), (None, leak), (None, None), (4, "\n \t"), (5, "ok")]
    benchmark = spark.createDataFrame([*ITEMS, (None, prose(50, 9))], "item_id long, text string")
    assert pairs(decontam.leaks(awkward(spark, rows), benchmark)) == {(3, 1), (None, 1)}
    kept = decontam.without_leaks(awkward(spark, rows), benchmark)
    assert kept.columns == awkward(spark).columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, None), (2, ""), (3, "clean"), (None, None), (4, "\n \t"), (5, "ok")], key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.leaks(awkward(spark), none).count() == 0
    assert searched(spark, [], ITEMS).count() == 0


def test_bound_that_bounds_nothing_is_refused(spark):
    with pytest.raises(ValueError):
        searched(spark, [], ITEMS, window=40, edits=5)


def symbol_runs(text):
    """The runs of symbols of a text, one list for each place between words."""
    between = "".join("a" if c.isalnum() or ord(c) > 0xFFFF else c for c in text).split("a")
    return [part.split() for part in between]


def slow_short(text, item):
    """Whether a text holds an item below 120 characters, by the whole table; no item is left out."""
    norm, texts = plain(item).strip(), plain(text).strip()
    if not norm:
        runs = item.split()
        return any(runs == part[i : i + len(runs)] for part in symbol_runs(text) for i in range(len(part)))
    if len(norm) < 8:
        return f" {norm} " in f" {texts} "
    return distance_of_best_part(norm, texts) <= (len(norm) // 12 if len(norm) >= 16 else 0)


def test_short_items_against_whole_alignment(spark):
    rng, source = random.Random(8), "what is the capital city of the small island"
    items = [(n, source[n % 3 : n % 3 + n].strip()) for n in range(1, 40)]
    items += [(50, "?!"), (51, "+ -"), (52, " ::\n"), (53, "42"), (54, "a"), (55, "a"), (56, "中文"), (57, "_")]
    rows = [(1, "no?! so"), (2, "no ?!? so"), (3, "x + - y"), (4, "x +- y"), (5, "std::vector"), (6, "a :: b"), (7, "142 421")]
    rows += [(8, "(42)"), (9, "a"), (10, "ab ba"), (11, "A."), (12, "x中文"), (13, "x 中文"), (14, "the"), (15, "? !"), (16, "snake_case")]
    for n in range(200):
        at = rng.randrange(30)
        part = edited(source[at : at + rng.randrange(5, 44)], rng.randrange(0, 4), rng)
        rows.append((100 + n, f"{prose(3, n)}{rng.choice(' ,x')}{part}{rng.choice(' ,x')}{prose(3, n + 1)}"))
    want = {(d, i) for d, t in rows for i, x in items if slow_short(t, x)}
    assert {i for _, i in want} >= {*range(8, 30), *range(50, 58)}
    assert pairs(searched(spark, rows, items)) == want


@pytest.mark.parametrize("slab", [16, 20, 60])
def test_short_items_at_the_ends_of_slabs(slab, monkeypatch):
    items = decontam.Items([(1, "to be"), (2, "question mark"), (3, "--")], decontam.WINDOW, decontam.EDITS, decontam.SHORTEST_ITEM)
    monkeypatch.setattr(decontam, "SLAB", slab)
    for shift in range(70):
        found = decontam.Slab(items)
        found.add(0, "x" * shift + " to be, question mark -- " + "y" * 30)
        found.add(1, "x" * shift + "xto be to bee stop beto be---" + "y" * 30)
        found.flush()
        assert set(found.found) == {(0, 0), (0, 1), (0, 2)}
        assert all(edits == 0 for edits, *_ in found.found.values())


def test_halves_of_a_slab_end_no_word(monkeypatch):
    items = decontam.Items([(1, "x"), (2, "again and " * 30)], decontam.WINDOW, decontam.EDITS, decontam.SHORTEST_ITEM)
    monkeypatch.setattr(decontam, "MOST_HITS", 1000)
    for shift in range(3):
        found = decontam.Slab(items)
        found.add(0, "x" * shift + "again and " * 100 + "x" * 2000 + "again and" * 100)
        found.flush()
        assert (0, 0) not in found.found or shift == 1


def test_passage_across_two_rows_is_found_in_both():
    """Whatever band the passage falls in, and with the joining space or without."""
    item = prose(60, 4)[:290]
    items = decontam.Items([(1, item)], decontam.WINDOW, decontam.EDITS, decontam.SHORTEST_ITEM)
    middle = item.index(" ", 140)
    for shift in range(2 * items.band):
        for lost in range(14):
            slab = decontam.Slab(items)
            slab.add(0, "x" * shift + " " + item[:middle])
            slab.add(1, item[middle + lost :])
            slab.add(2, "clean")
            slab.flush()
            assert set(slab.found) == {(0, 0), (1, 0)}


def test_repeated_items_and_bounded_blocks(spark, monkeypatch):
    sent, searched_before = [], decontam._searched

    def noted(texts, block, *options):
        sent.append(block)
        return searched_before(texts, block, *options)

    monkeypatch.setattr(decontam, "_searched", noted)
    items = [ITEMS[0]] * 50 + [ITEMS[1], (6, ITEMS[1][1]), ITEMS[4]]
    rows = [(1, f"{ITEMS[0][1]} and {ITEMS[1][1]}"), (2, ITEMS[4][1] + " end")]
    assert pairs(searched(spark, rows, items, block_chars=600)) == {(1, 1), (1, 2), (1, 6), (2, 5)}
    assert sorted(i for block in sent for i, _ in block) == [1, 2, 5, 6]
    assert len(sent) > 1 and all(sum(len(t) for _, t in block) <= 600 for block in sent)


def test_short_items_are_counted_and_can_be_left_out(spark):
    documents = spark.createDataFrame([(1, "one word here"), (2, "another Word"), (3, "none"), (4, prose(60, 3))], "doc_id long, text string")
    items = spark.createDataFrame([(1, "word"), (2, prose(60, 3)), (3, "missing")], "item_id long, text string")
    counts = {tuple(r) for r in decontam.leaks_per_item(decontam.leaks(documents, items)).collect()}
    assert counts == {(1, 2, 2), (2, 1, 1)}
    kept = lambda **o: {r.doc_id for r in decontam.without_leaks(documents, items, **o).collect()}
    assert kept() == {3} and kept(shortest=10) == {1, 2, 3}
