from hypothesis import given, settings
from hypothesis import strategies as st
from parity import compare, connect
from pyspark.sql import functions as F

from tidemart.llm import chat, queries

EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"


def folded(spark, rows):
    got = chat.fold(spark.createDataFrame(rows, EVENTS)).collect()
    return {(r.conv_id, r.message): (r.role, r.text) for r in got}


def test_query_matches_sql(spark, sf_dir):
    con = connect(sf_dir)
    assert compare(queries.QUERIES["op9_chat"](spark, sf_dir), con, queries.ORACLE_SQL["op9_chat"]) == []


def test_edits_regenerations_and_deltas(spark):
    rows = [
        (1, 0, 0, "start", "user", None), (1, 1, 0, "delta", None, "Hi"), (1, 2, 0, "delta", None, " there"),
        (1, 9, 0, "edit", None, "Hello"), (1, 10, 0, "delta", None, "!"),
        (1, 3, 1, "start", "assistant", None), (1, 4, 1, "delta", None, "wrong"), (1, 5, 1, "regenerate", None, None),
        (1, 6, 1, "delta", None, "ri"), (1, 7, 1, "delta", None, "ght"), (1, 7, 1, "delta", None, "ght"),
        (2, 0, 0, "start", "user", "at once"), (2, 1, 0, "retract", None, None),
        (3, 0, 5, "delta", None, "no start"), (3, 1, 6, "start", None, None),
    ]
    assert folded(spark, rows) == {
        (1, 0): ("user", "Hello!"),
        (1, 1): ("assistant", "right"),
        (3, 5): ("unknown", "no start"),
        (3, 6): ("unknown", ""),
    }


def test_order_of_arrival_does_not_matter(spark):
    rows = [(1, i, 0, "delta" if i else "start", "user", f"{i},") for i in range(200)]
    assert folded(spark, rows[::-1])[(1, 0)] == ("user", "".join(f"{i}," for i in range(200)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="\\bhlc#<>/turn: A\n", max_size=12), st.text(alphabet="\\bhlc#<>/turn: A\n", max_size=20)), max_size=5), st.integers(1, 9))
def test_escapes_are_reversible_whatever_the_text(turns, size):
    def escape(value, pairs):
        for plain, code in pairs:
            value = value.replace(plain, code)
        return value

    output = "".join(
        chat.OPEN + escape(role, chat.ROLE_ESCAPES) + chat.BETWEEN + escape(text, chat.ESCAPES) + chat.CLOSE
        for role, text in turns
    )
    pieces = (output[i : i + size] for i in range(0, len(output), size))
    assert list(chat.read_turns(pieces)) == turns


def test_mask_covers_assistant_texts_only(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a # b"), (1, 1, "assistant", "c \\ <d>"), (1, 2, "assistant", ""), (1, 3, "ass:istant", "x")],
        "conv_id long, turn long, role string, text string",
    )
    rows = chat.format_chats(chat.events_of_turns(turns)).orderBy("start").collect()
    output = "".join(r.formatted for r in rows)
    assert [r.start for r in rows] == [output.index(r.formatted) for r in rows]
    masked = [chat.unescaped(output[r.loss_start : r.loss_end]) for r in rows if r.loss_start is not None]
    assert masked == ["c \\ <d>", ""]
    assert list(chat.read_turns(iter([output]))) == [(t.role, t.text) for t in turns.collect()]


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (1, None, "user", "last"), (1, 0, None, None), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
        (2, 5, "assistant", "x" * 100_000), (3, 1, "assistant", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("seq", F.lit(3)).withColumn("message", F.lit("m")).withColumn("kind", F.lit("k"))
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(chat.events_of_turns(frame))).collect()}
    assert {i: r.n_turns for i, r in got.items()} == {None: 1, 1: 4, 2: 1, 3: 1}
    assert {i: r.loss_chars for i, r in got.items()} == {None: 0, 1: 0, 2: 100_000, 3: 0}
    assert chat.digests(chat.format_chats(chat.events_of_turns(frame.limit(0)))).count() == 0


def test_conversation_with_most_turns(spark):
    turns = spark.range(5000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"),
    )
    (row,) = chat.digests(chat.format_chats(chat.events_of_turns(turns))).collect()
    assert row.n_turns == 5000 and row.loss_chars == sum(len(str(i)) for i in range(1, 5000, 2))
