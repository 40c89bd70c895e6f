"""WARC archives: pages written as records, and records found again by verifying the chain of boundaries.

A record says how long it is, so it names the place of its successor. Archives are read in splits, and a
split knows neither where the records before it end nor whether a version line that it meets opens a
record or stands inside a payload. So each task emits a candidate for every version line at the start of
a line: its offset and the offset of its successor. A candidate counts only if it can be reached from the
start of its file. Candidates of a split whose successor is the very next one form a run, and pointer jumping
over the runs marks the reachable ones in as many rounds as the number of runs on the longest
path has binary digits. Candidates never reached are text of some payload.

Texts are scanned twice and stay where they are: once for the candidates, once for the payloads. Only
records whose payload holds a version line are put together from several places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemart.llm.tables import stored
from tidemart.operators.skew import splittable_join
from tidemart.session import scratch_path

# Fixed values of the format.
LINE, BLANK = "\r\n", "\r\n\r\n"
VERSION = "WARC/1.1"
MAGIC = "WARC/1."
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# A header field of our own, for the id of the page.
PAGE_ID = "X-Page-ID"
# Line feed and start of a version line. No beginning of it is an ending of it, so a scan that starts
# in the middle of one cannot miss the next.
_CUT = "\n" + MAGIC

# Shorter payloads are written each time.
SHORTEST = 100
WRITTEN_AT = "1970-01-01T00:00:00Z"


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends and version lines in a value are escaped."""
    text = value.cast("string")
    for plain, code in (("\r", "%0D"), ("\n", "%0A")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit(LINE)), F.lit(""))


def _record_id(page_id: Column, digest: Column) -> Column:
    """A name that follows from the page and its payload."""
    named = F.md5(F.concat_ws(":", page_id.cast("string"), digest))
    parts = F.regexp_replace(named, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.concat(F.lit("<urn:uuid:"), parts, F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    shortest: int = SHORTEST,
    written_at: str = WRITTEN_AT,
) -> None:
    """Write one record per page into archives below ``path``, a file per task.

    Of pages with equal payloads of at least ``shortest`` bytes the one with the smallest id is a
    response, the others are revisits that refer to it and hold no payload; rows that share the smallest id
    are all responses. A page without an id revisits like any other and is never referred to. Null payloads are
    empty, a null url has no field. An empty table gives no record. Other columns are ignored.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    )
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    repeated = (
        rows.where(F.octet_length("payload") >= shortest)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1 and first_id is not null")
        .select("digest", "first_id")
    )
    # Stored, so that its size is known before the payloads would have to be shuffled to it.
    met = rows.join(stored(repeated, "repeated"), "digest", "left")
    revisits = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(BLANK),
    )
    met = met.select("*", revisits.alias("revisits"), http.alias("http"))
    held = F.when(F.col("revisits"), F.lit("")).otherwise(F.col("payload"))
    refers_to = F.when(F.col("revisits"), _record_id(F.col("first_id"), F.col("digest")))
    record = F.concat(
        F.lit(VERSION + LINE),
        _field("WARC-Type", F.when(F.col("revisits"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _field("WARC-Date", F.lit(written_at)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Profile", F.when(F.col("revisits"), IDENTICAL_PAYLOAD)),
        _field("WARC-Refers-To", refers_to),
        _field(PAGE_ID, F.col("page_id")),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", F.octet_length("http") + F.octet_length(held)),
        F.lit(LINE),
        "http",
        held,
    )
    # Two line ends close a record.
    met.select(record.alias("value")).write.option("lineSep", BLANK).text(path)


def _fixed_splits(spark: SparkSession) -> SparkSession:
    """A session like this one whose splits of a file follow from the files and settings alone."""
    reader = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and reader.conf.isModifiable(key):
            reader.conf.set(key, value)
    reader.conf.set("spark.sql.files.minPartitionNum", "1")
    return reader


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut before each line that starts like a version line.

    Returns ``file, file_size, block, row, value``: the split it was read in and an order within it. All reads
    of one result number the rows alike.
    """
    cut = _fixed_splits(spark).read.option("lineSep", _CUT).text(path)
    return cut.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def _header(name: str) -> Column:
    """A field of ``head``, null if it is not there."""
    found = F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", F.rtrim(found))


def _with_head(rows: DataFrame) -> DataFrame:
    """``rows`` with the header of ``value`` up to its blank line, and its length; null if it has none."""
    head = F.substring_index("value", BLANK, 1)
    # The cut took the last byte of the blank line where the block starts with a version line.
    taken = F.col("value").endswith(BLANK[:-1])
    rows = rows.withColumn(
        "head",
        F.when(F.octet_length(head) < F.octet_length("value"), head).when(
            taken, F.left("value", F.char_length("value") - len(BLANK) + 1)
        ),
    )
    length = _header("Content-Length")
    return rows.withColumn("content", F.when(length.rlike(r"^\d{1,15}$"), length.cast("long")))


def _before(*columns: str) -> WindowSpec:
    """All rows before this one, in order of the last column and apart by the others."""
    window = Window.partitionBy(*columns[:-1]).orderBy(columns[-1])
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _placed(spark: SparkSession, cut: DataFrame) -> DataFrame:
    """Each fragment without its text: its offset, and for candidates that of the successor.

    Lengths are added up within a split, and over the splits of a file; all rows of a file never meet.
    """
    sizes = _with_head(cut).select(
        "file", "file_size", "block", "row",
        F.octet_length("value").cast("long").alias("size"),
        F.col("value").rlike(r"^WARC/1\.[01]\r\n").alias("opens"),
        F.col("value").rlike(r"^[01]\r\n").alias("goes_on"),
        (F.octet_length("head") + len(BLANK)).cast("long").alias("head_size"),
        "content",
    )
    path = scratch_path(spark, "fragments")
    sizes.write.parquet(path)
    sizes = spark.read.schema(sizes.schema).parquet(path)
    reach = F.col("size") + len(_CUT)
    blocks = sizes.groupBy("file", "block").agg(F.sum(reach).alias("reach"))
    base = F.coalesce(F.sum("reach").over(_before("file", "block")), F.lit(0)).alias("base")
    within = F.coalesce(F.sum(reach).over(_before("file", "block", "row")), F.lit(0))
    at_value = sizes.withColumn("within", within).join(blocks.select("file", "block", base), ["file", "block"])
    at_value = at_value.withColumn("value_at", F.col("base") + F.col("within"))
    first = F.col("value_at") == 0
    valid = F.when(first, F.col("opens")).otherwise(F.col("goes_on")) & F.col("content").isNotNull()
    ends = F.col("value_at") + F.col("head_size") + F.col("content")
    return at_value.select(
        "file", "file_size", "block", "row", "size", "value_at",
        F.when(first, 0).otherwise(F.col("value_at") - len(MAGIC)).alias("at"),
        F.when(valid, ends).alias("ends"),
        F.when(valid, ends + len(BLANK)).alias("successor"),
    )


def _reached(placed: DataFrame) -> DataFrame:
    """``(file, row, at, successor)`` of the candidates on the chain from the start of their file."""
    split = Window.partitionBy("file", "block").orderBy("row")
    candidates = placed.where("successor is not null").withColumn("following", F.lead("at").over(split))
    ends_run = F.coalesce(F.col("successor") != F.col("following"), F.lit(True))
    from_end = Window.partitionBy("file", "block").orderBy(F.desc("row"))
    so_far = from_end.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail = F.last(F.when(ends_run, F.col("at")), ignorenulls=True).over(so_far)
    members = stored(candidates.select("file", "row", "at", "successor", tail.alias("tail")), "runs")

    into = members.select("file", F.col("at").alias("successor"), F.col("tail").alias("to"))
    runs = members.where("at = tail").select("file", "tail", "successor")
    links = stored(runs.join(into, ["file", "successor"]), "links")
    first = members.where("at = 0").select("file", "tail")
    jump, reached = links.select("file", "tail", "to"), stored(first, "reached")
    while True:
        ahead = stored(reached.join(jump, ["file", "tail"]).select("file", F.col("to").alias("tail")), "ahead")
        if ahead.isEmpty():
            break
        reached = stored(reached.unionByName(ahead), "reached")
        then = jump.select("file", F.col("tail").alias("to"), F.col("to").alias("beyond"))
        twice = jump.join(then, ["file", "to"]).select("file", "tail", F.col("beyond").alias("to"))
        jump = stored(twice, "jump")

    entered = links.join(reached, ["file", "tail"]).select("file", F.col("to").alias("tail"), F.col("successor").alias("entry"))
    entries = entered.unionByName(first.withColumn("entry", F.lit(0).cast("long")))
    on_chain = members.join(entries, ["file", "tail"]).where("at >= entry")
    return on_chain.select("file", "row", "at", "successor")


def _others(placed: DataFrame, reached: DataFrame) -> DataFrame:
    """``(row, at, owner)`` of all fragments that do not hold a whole record of their own.

    ``owner`` is the offset of the record that the fragment is a part of; text of no whole record has none.
    """
    verified = reached.select("row", F.struct("at", "successor").alias("record"))
    marked = stored(placed.join(verified, "row", "left"), "marked")
    split = Window.partitionBy("file", "block").orderBy("row")
    so_far = F.max("record").over(split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last_of_split = marked.groupBy("file", "block").agg(F.max("record").alias("last"))
    carried = last_of_split.select("file", "block", F.max("last").over(_before("file", "block")).alias("carried"))
    owned = marked.withColumn("so_far", so_far).join(carried, ["file", "block"])
    owner = F.coalesce("so_far", "carried")
    inside = (F.col("at") < owner["successor"]) & (F.col("file_size") >= owner["successor"] - len(BLANK))
    holds_all = F.col("record").isNotNull() & (F.col("value_at") + F.col("size") >= F.col("ends"))
    others = owned.where(~holds_all | holds_all.isNull())
    return others.select("row", "file", "at", F.when(inside, owner["at"]).alias("owner"))


def _parsed(rows: DataFrame) -> DataFrame:
    """Header fields and payload of the record that each ``value`` starts with."""
    rows = _with_head(rows)
    block = F.substr(F.col("value").cast("binary"), F.octet_length("head") + len(BLANK) + 1, F.col("content").cast("int"))
    rows = rows.withColumn("body", block)
    http = F.octet_length(F.substring_index(F.col("body").cast("string"), BLANK, 1)) + len(BLANK)
    is_http = F.coalesce(_header("Content-Type").startswith("application/http"), F.lit(False))
    return rows.select(
        "file",
        _header("WARC-Type").alias("type"),
        _header("WARC-Record-ID").alias("record_id"),
        _header("WARC-Refers-To").alias("refers_to"),
        _header("WARC-Target-URI").alias("url"),
        _header(PAGE_ID).cast("long").alias("page_id"),
        F.when(is_http, F.substr("body", http + 1)).otherwise(F.col("body")).alias("payload"),
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``: ``file, type, record_id, refers_to, url, page_id, payload``.

    ``payload`` has the bytes without the head of an HTTP message; that of a revisit is empty. Version lines that are
    not reached from the start of their file open no record. A record that the end of its file cuts is left
    out, and so is what follows bytes that are no record; :func:`unread` tells where. Empty files have no record.
    A record is held by one task, a file never is, and no split holds up another.
    """
    cut = fragments(spark, path)
    placed = stored(_placed(spark, cut), "placed")
    others = stored(_others(placed, _reached(placed)), "others")
    whole = _parsed(cut.join(others.select("row"), "row", "left_anti"))
    parts = others.where("owner is not null").select("row", "owner", "at")
    gathered = cut.join(parts, "row").groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts")
    )
    joined = gathered.select("file", F.array_join(F.col("parts.value"), _CUT).alias("value"))
    return whole.unionByName(_parsed(joined))


def unread(spark: SparkSession, path: str) -> DataFrame:
    """``(file, file_size, at)`` of the archives whose chain of records breaks off before their end, and where."""
    placed = stored(_placed(spark, fragments(spark, path)), "placed")
    ends = placed.select("row", "file_size", "ends").join(_reached(placed), "row").where("ends <= file_size")
    read = ends.groupBy("file").agg(F.max("successor").alias("at"))
    files = placed.select("file", "file_size").distinct().join(read, "file", "left")
    at = F.coalesce("at", F.lit(0))
    return files.where(at < F.col("file_size")).select("file", "file_size", at.alias("at"))


def resolved(records: DataFrame) -> DataFrame:
    """Per response and revisit ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Size and digest (SHA-256, hex) are those of the full payload; a revisit's come from the response it refers to, as does
    ``refers_to``, that page's id. They are null if no record has that name. Other types are left out.
    """
    is_page = F.col("type").isin("response", "revisit")
    size = F.octet_length("payload").cast("long")
    digested = records.where(is_page).select(
        "type", "record_id", "refers_to", "page_id", size.alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")
    )
    facts = stored(digested, "facts")
    responses = facts.where("type = 'response'")
    result = ["page_id", "payload_bytes", "payload_digest"]
    # Rows of one name are copies of one page.
    named = responses.where("record_id is not null").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.struct(*(F.any_value(c).alias(c) for c in result)).alias("first")
    )
    revisits = facts.where("type = 'revisit'").select("page_id", "refers_to")
    met = splittable_join(revisits, named, ["refers_to"], "left")
    return responses.select(
        *result, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")
    ).unionByName(
        met.select(
            "page_id", "first.payload_bytes", "first.payload_digest", F.lit("revisit").alias("record_type"),
            F.col("first.page_id").alias("refers_to"),
        )
    )
