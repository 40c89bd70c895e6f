"""The queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    bpe,
    chat,
    chunks,
    collocations,
    decontam,
    filter_audit,
    html_extract,
    line_dedup,
    quality,
    secret_scan,
    sharding,
    simhash,
    warc,
)
from tidemart.session import scratch_path

RANKS = "byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    joined, keep, n_dropped = line_dedup.with_bitmaps(documents)
    kept = line_dedup.kept_text(F.coalesce("text", F.lit("")), keep)
    return joined.select(
        "doc_id",
        F.size(line_dedup.lines_of("text")).cast("long").alias("n_lines"),
        F.coalesce(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.bounded_shards(_table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, name), ",")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "edits", "start", "end")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.vocabulary(spark, public_tokenizers.path(RANKS))
    return bpe.round_trip(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    classifier = quality.train(documents, _table(spark, sf_dir, "labels"))
    return quality.scored(documents, classifier).select(
        "doc_id",
        quality.is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_extract.extract(_table(spark, sf_dir, "pages"))
    return extracted.withColumn("n_chars", F.char_length("text").cast("long"))


# A conversation whose texts look like the template's own control strings.
TRICKY_ID, TRICKY_TEXT = -7, "\\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(TRICKY_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY_TEXT).alias("text"),
    )
    events = chat.events_of_turns(turns.unionByName(tricky))
    return chat.digests(chat.format_chats(events))


def op10_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.likeness(_table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.read_archives(spark, path))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_secrets": op4_secrets,
    "op5_decontamination": op5_decontamination,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_quality": op7_quality,
    "op8_html": op8_html,
    "op9_chat": op9_chat,
    "op10_chunks": op10_chunks,
    "op11_warc": op11_warc,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
}

_WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": f"""
        with texts as (
            select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
        ),
        lines as (
            select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from texts
        ),
        keyed as (
            select doc_id, pos, line, translate(
                trim(line, {_WHITE}), '{line_dedup.UPPER}', '{line_dedup.LOWER}') as key
            from lines
        ),
        firsts as (
            select key, min(doc_id) as first_doc from keyed
            where length(key) >= 10 group by key having count(distinct doc_id) >= 2
        ),
        marked as (
            select k.*, coalesce(k.doc_id <> f.first_doc, false) as gone
            from keyed k left join firsts f on k.key = f.key
        )
        select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), ''))
                   as kept_sha256
        from marked group by doc_id
    """,
    "op9_chat": f"""
        with turns as (
            select conv_id, turn, role, coalesce(text, '') as text from conversations
            union all
            select {TRICKY_ID}, unnest([0, 1]), unnest(['user', 'assistant']), '{TRICKY_TEXT}'
        )
        select conv_id, count(*)::bigint as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), ''))
                   as loss_sha256,
               sum(length(role) + length(regexp_replace(text, '[\\\\#<]', '..', 'g'))
                   + {len(chat.OPEN + chat.BETWEEN + chat.CLOSE)})::bigint as formatted_chars
        from turns group by conv_id
    """,
    "op11_warc": """
        with payloads as (
            select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as size from pages
        ),
        firsts as (select *, min(page_id) over (partition by payload) as first_id from payloads)
        select page_id, size::bigint as payload_bytes, sha256(payload) as payload_digest,
               case when size >= 100 and first_id <> page_id then 'revisit' else 'response' end as record_type,
               case when size >= 100 and first_id <> page_id then first_id end as refers_to
        from firsts
    """,
    "op12_filter_audit": r"""
        with recursive texts as (
            select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents
        ),
        worded as (
            select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
                   min(doc_id) over (partition by text) as first_id
            from texts
        ),
        marked as (
            select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
            from labels group by doc_id
        ),
        failing as (
            select w.part,
                   case when len(words) < 200 then 'A' else '' end
                   || case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end
                   || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)
                           then 'C' else '' end
                   || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
                   || case when first_id < w.doc_id then 'E' else '' end as fails,
                   coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
            from worded w left join marked m on w.doc_id = m.doc_id
        ),
        classes as (
            select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic
            from failing group by part, fails
        ),
        letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter),
        grown as (
            select letter as filter_order from letters
            union all
            select filter_order || letter from grown, letters
            where length(filter_order) < 5 and not contains(filter_order, letter)
        ),
        steps as (
            select filter_order, step, filter_order[step] as letter, filter_order[1:step - 1] as before
            from (select filter_order from grown where length(filter_order) = 5),
                 (select unnest([1, 2, 3, 4, 5]) as step)
        ),
        met as (
            select part, filter_order, step, letter, n, good, toxic, fails = letter as only_this,
                   contains(fails, letter) as hit,
                   length(translate(fails, before, '')) < length(fails) as gone
            from classes, steps
        ),
        counted as (
            select part, filter_order, step, letter,
                   coalesce(sum(n) filter (not hit and not gone), 0)::bigint as kept,
                   coalesce(sum(n) filter (hit and not gone), 0)::bigint as removed,
                   coalesce(sum(n) filter (hit and gone), 0)::bigint as redundant,
                   coalesce(sum(n) filter (only_this), 0)::bigint as unique_fails,
                   coalesce(sum(good) filter (hit and not gone), 0)::bigint as good_lost,
                   coalesce(sum(toxic) filter (hit and not gone), 0)::bigint as toxic_lost
            from met group by part, filter_order, step, letter
        )
        select part, filter_order, step::int as step, kept, removed, redundant, unique_fails,
               good_lost, toxic_lost, sum(removed) over (partition by part, letter)::bigint as shapley
        from counted
    """,
    "op13_collocations": r"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
            from documents
        ),
        worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
        starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from worded),
        occurrences as (
            select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
            from starts, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(w)
        ),
        counts as (
            select lang, k, phrase, count(*)::hugeint as f from occurrences group by lang, k, phrase
        ),
        totals as (select lang, sum(f)::bigint as n from counts where k = 1 group by lang),
        frequent as (select * from counts where f >= 30),
        candidates as (select *, string_split(phrase, ' ') as w from frequent where k > 1),
        parted as (
            select lang, phrase, f as a, cut, array_to_string(w[1:cut], ' ') as first_part,
                   array_to_string(w[cut + 1:k], ' ') as rest
            from candidates, (select unnest([1, 2, 3]) as cut) where cut < k
        ),
        cuts as (
            select p.*, x.f as l, y.f as r, (2000000 * a) // (x.f + y.f) as score
            from parted p
            join frequent x on x.lang = p.lang and x.phrase = p.first_part
            join frequent y on y.lang = p.lang and y.phrase = p.rest
        ),
        best as (
            select * from cuts
            qualify row_number() over (partition by lang, phrase order by score, cut) = 1
        ),
        covered as (
            select s.lang, s.phrase
            from candidates s, candidates b
            where s.lang = b.lang and s.k < b.k and contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')
              and 100 * b.f >= 80 * s.f
        ),
        ranked as (
            select b.*, row_number() over (
                partition by lang order by score desc, a desc, encode(phrase)) as rank
            from best b anti join covered c on b.lang = c.lang and b.phrase = c.phrase
        )
        select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n,
               score::bigint as score
        from ranked join totals using (lang) where rank <= 2000
    """,
}
