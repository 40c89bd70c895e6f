import importlib
from pathlib import Path

import corpus_pipeline
from llm.helpers import AWKWARD, prose
from llm.test_bpe import digests
from llm.test_decontam import plain
from llm.test_line_dedup import expected as without_lines
from llm.test_simhash import expected as simhash_expected
from pyspark.sql import functions as F

from tidemart.llm import queries
from tidemart.llm import tables as llm_tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(spark, path):
    """Clean prose, junk, near copies, a common line and a leak, each in documents of their own."""
    rows = [(n, prose(80, n)) for n in range(40)]
    rows += [(100 + n, "*** BUY!! NOW!! " * 20 + str(n)) for n in range(30)]
    rows += [(200 + n, "A line that many documents share.\n" + prose(80, 50 + n)) for n in range(5)]
    rows += [(300, prose(300, 90)), (301, prose(300, 90) + " end"), (302, prose(300, 90))]
    leak = prose(50, 97)
    rows += [(400, prose(60, 91) + "\n" + leak + "\n" + prose(60, 92))]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    documents = documents.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    documents.write.parquet(f"{path}/documents.parquet")
    labels = [(n, int(n < 100), 0) for n in [*range(30), *range(100, 125)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return {i for i, _ in rows}


def test_each_stage_takes_effect(spark, tmp_path):
    everything = tables(spark, str(tmp_path))
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == COLUMNS
    good = {i for i in everything if not 100 <= i < 200}
    assert set(seen["quality_classifier"]) == good
    assert set(seen["line_dedup"]) == good
    shared = [i for i, r in seen["line_dedup"].items() if "many documents share" in r.text]
    assert shared == [200]
    assert all(r.n_chars == len(r.text) for r in seen["line_dedup"].values())
    # The copy 302 lost its only line before; an empty text is like no other here.
    assert seen["line_dedup"][302].text == ""
    assert set(seen["near_duplicates"]) == good - {301}
    assert set(seen["decontamination"]) == good - {301, 400}
    assert set(seen["byte_bpe"]) == good - {301, 400}
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(seen["byte_bpe"]) and all(r.n_tokens == len(r.ids) for r in rows)


def test_against_a_plain_version(spark, sf_dir):
    """All stages over the supplied documents, each redone without Spark but for the scores."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scores = {r.doc_id: r.score for r in queries.QUERIES["op7_quality"](spark, sf_dir).collect()}
    rows = [tuple(r) for r in table.collect() if scores[r.doc_id] >= 0.7]
    rows = [(i, text) for (i, _), text in zip(rows, without_lines(rows), strict=True)]
    component = {i: least for i, _, least in simhash_expected(rows)}
    rows = [(i, text) for i, text in rows if component[i] == i]
    items = [plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [(i, text) for i, text in rows if not any(item in plain(text or "") for item in items)]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert 100 < len(rows) < 200
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == {
        i: digests(text or "") for i, text in rows
    }


def test_empty_documents(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0


def test_registered_with_the_operators():
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" in entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in entry.queries()) for n in range(1, 14))


def test_nothing_is_left_in_the_scratch_folder(spark, tmp_path, monkeypatch):
    tables(spark, str(tmp_path))
    made = []
    monkeypatch.setattr(corpus_pipeline, "scratch_path", lambda _, label: made.append(f"{tmp_path}/{label}") or made[-1])
    monkeypatch.setattr(llm_tables, "scratch_path", lambda _, label: made.append(f"{tmp_path}/{label}-{len(made)}") or made[-1])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert len(made) > 8
    assert [p for p in made if Path(p).exists()] == [f"{tmp_path}/pipeline-byte_bpe"]


def test_awkward_rows_pass_all_stages(spark, tmp_path):
    """Nulls, empty, long and repeated rows; with no label nothing is rejected."""
    lang = ["en", None]
    rows = [(i, t, lang[n % 2], None, None if t is None else len(t)) for n, (i, t) in enumerate([*AWKWARD, *AWKWARD])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "byte_bpe":
            assert docs.columns == COLUMNS
            left = {i for i, in docs.select("doc_id").collect()}
            assert left <= {i for i, in before.select("doc_id").collect()}
        if name == "quality_classifier":
            assert docs.count() == len(rows)
        if name == "line_dedup":
            texts = without_lines([r[:2] for r in rows])
            assert sorted((r.text for r in docs.collect()), key=str) == sorted(texts, key=str)
    kept = [tuple(r)[:4] for r in docs.collect()]
    # Null and empty texts are one group, whose smallest id stays.
    assert {i for i, *_ in kept} >= {1, 6, 10} and not {i for i, *_ in kept} & {4, 5, 8}
    for doc_id, n_tokens, ids, decoded in kept:
        text = {r.text or "" for r in spark.read.parquet(f"{tmp_path}/decontamination").where(F.col("doc_id").eqNullSafe(F.lit(doc_id))).collect()}
        assert (n_tokens, ids, decoded) in {digests(t) for t in text}
