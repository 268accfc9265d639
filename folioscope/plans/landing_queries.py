"""Queries on sources and sinks: what is written to the shared folder is read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioscope import schema as S
from folioscope.operators import ordinal, quality
from folioscope.plans import ingest
from folioscope.plans.registry import query, table
from folioscope.session import scratch_path, stable
from folioscope.sources import landed, marks, sinks
from folioscope.streaming import ingest as stream

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGE = 100


@query("src_jsonl", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def src_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    table(spark, sf, "documents").write.json(path)
    return landed.read_json_lines(spark, path, DOCUMENTS).drop(landed.CORRUPT)


@query(
    "src_jsonl_rejects",
    """
    SELECT CASE WHEN turn % 2 = 1 THEN '' ELSE conv_id || '/' || turn END AS kept,
      CASE WHEN turn % 2 = 1 THEN '{"conv_id": ' || conv_id || ', "turn": ' || turn || ', ' ELSE '' END
        AS rejected
    FROM conversations
    """,
)
def src_jsonl_rejects(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    start = F.format_string('{"conv_id": %d, "turn": %d', "conv_id", "turn")
    # every second line is cut off
    line = F.concat(start, F.when(F.col("turn") % 2 == 1, F.lit(", ")).otherwise(F.lit("}")))
    path = scratch_path(spark, "jsonl")
    turns.select(line.alias("value")).write.text(path)
    rows = landed.read_json_lines(spark, path, "conv_id bigint, turn bigint")
    rejected = F.col(landed.CORRUPT)
    return rows.select(
        F.when(rejected.isNull(), F.concat("conv_id", F.lit("/"), "turn"))
        .otherwise("")
        .alias("kept"),
        F.coalesce(rejected, F.lit("")).alias("rejected"),
    )


def pulls(events):
    """Events in folders named like the pulls of an archive."""
    pull = (
        F.when(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"), "osf-beginning-to-2024-01-07")
        .when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "osf-2024-01-08-to-2024-01-15")
        .otherwise("osf-2024-01-16-to-current")
    )
    return events.withColumn("pull", pull)


@query(
    "src_multi_file",
    "SELECT conv_id, turn, role, md5(text) AS text FROM conversations",
)
def src_multi_file(spark, sf):
    path = scratch_path(spark, "files")
    turns = table(spark, sf, "conversations")
    turns.withColumn("part", F.concat(F.lit("osf-"), F.col("conv_id") % 5)).write.partitionBy(
        "part"
    ).json(path)
    rows = landed.read_json_lines(
        spark, f"{path}/part=osf-*", "conv_id bigint, turn bigint, role string, text string"
    )
    return rows.select("conv_id", "turn", "role", F.md5("text").alias("text"))


@query(
    "src_file_order",
    """
    SELECT CASE WHEN ts < '2024-01-08' THEN 'osf-00' WHEN ts < '2024-01-16'
        THEN 'osf-2024-01-08-to-2024-01-15' ELSE 'osf-2024-01-16-to-current' END AS file,
      row_number() OVER (ORDER BY file, event_id) AS arrival, event_id
    FROM events
    """,
)
def src_file_order(spark, sf):
    # a folder above that is itself named like a pull must not matter
    path = scratch_path(spark, "pulls") + "/osf-pulls"
    pulls(table(spark, sf, "events").select("event_id", "ts")).write.partitionBy("pull").json(path)
    rows = landed.read_json_lines(spark, path, "event_id bigint", with_file=True)
    ranked = rows.select("event_id", landed.file_rank(F.col("file")).alias("file"))
    return ordinal.with_ordinal(ranked, ["file", "event_id"], "arrival")


@query(
    "src_xml",
    """
    SELECT '0704.' || printf('%04d', page_id) AS id,
      rtrim('A < B & ' || regexp_extract(html, '<title>([^<]*)</title>', 1), chr(10) || chr(9) || ' ')
        AS title
    FROM pages
    """,
)
def src_xml(spark, sf):
    path = scratch_path(spark, "oai")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    record = F.struct(
        F.concat(F.lit("0704."), F.format_string("%04d", "page_id")).alias("id"),
        F.concat(F.lit("A <\n   B & "), title).alias("title"),
    )
    table(spark, sf, "pages").select(
        F.struct(F.concat(F.lit("oai:"), "page_id").alias("identifier")).alias("header"),
        F.struct(record.alias("arXiv")).alias("metadata"),
    ).write.format("xml").option("rootTag", "ListRecords").option("rowTag", "record").save(path)
    return landed.oai_ids(landed.read_oai_records(spark, path))


@query(
    "page_audit",
    f"""
    SELECT count(*) AS n_records, count(DISTINCT event_id // {PAGE}) AS n_tokens,
      count(*) AS list_size, (max(event_id) // {PAGE}) * {PAGE} AS last_cursor, true AS complete,
      ceil(count(*) / {PAGE})::BIGINT AS n_pages
    FROM events
    """,
)
def page_audit(spark, sf):
    path = scratch_path(spark, "oai")
    events = table(spark, sf, "events")
    records = events.select(
        F.struct(F.concat(F.lit("oai:"), "event_id").alias("identifier")).alias("header"),
        F.struct(
            F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("title")).alias("arXiv")
        ).alias("metadata"),
    )
    size = events.agg(F.count("*")).scalar()
    tokens = (
        events.select(F.floor(F.col("event_id") / PAGE).alias("page"))
        .distinct()
        .select(
            F.concat(F.lit("t"), "page").alias("_VALUE"),
            (F.col("page") * PAGE).alias("_cursor"),
            size.alias("_completeListSize"),
        )
    )
    for name, rows in (("record", records), ("resumptionToken", tokens)):
        rows.write.format("xml").option("rootTag", "ListRecords").option("rowTag", name).save(
            f"{path}/{name}"
        )
    audit = quality.page_audit(
        landed.read_oai_records(spark, f"{path}/*"), landed.read_oai_tokens(spark, f"{path}/*")
    )
    return audit.withColumn("n_pages", quality.page_count(F.col("list_size"), F.lit(PAGE)))


@query(
    "cursor_audit",
    f"""
    WITH positions AS (
      SELECT event_id % 3 AS list, row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1 AS pos
      FROM events),
    covered AS (
      SELECT list, pos, CASE WHEN (pos // {PAGE}) % 7 = 3 THEN 0 ELSE 1 END
        + CASE WHEN (pos // {PAGE}) % 5 = 2 THEN 1 ELSE 0 END AS times
      FROM positions),
    runs AS (
      SELECT *, pos - row_number() OVER (PARTITION BY list, times ORDER BY pos) AS run FROM covered)
    SELECT list, CASE WHEN times = 0 THEN 'missing' ELSE 'doubled' END AS kind, min(pos) AS start,
      max(pos) + 1 AS stop, times::BIGINT AS times
    FROM runs WHERE times <> 1 GROUP BY list, times, run
    """,
)
def cursor_audit(spark, sf):
    """Three lists; every seventh page of each is lost, and of every five one was landed twice."""
    order = Window.partitionBy("list").orderBy("event_id")
    positions = (
        table(spark, sf, "events")
        .select((F.col("event_id") % 3).alias("list"), "event_id")
        .withColumn("at", F.row_number().over(order) - 1)
    )
    page = F.floor(F.col("at") / PAGE)
    whole = positions.groupBy("list", page.alias("page")).agg(F.count("*").alias("n"))
    totals = positions.groupBy("list").agg(F.count("*").alias("total"))
    kept = F.when(F.col("page") % 7 == 3, 0).otherwise(1) + F.when(F.col("page") % 5 == 2, 1).otherwise(0)
    landed_pages = (
        whole.join(totals, "list")
        .withColumn("cursor", F.col("page") * PAGE)
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), kept)))
    )
    path = scratch_path(spark, "pages")
    landed_pages.select("list", "cursor", "n", "total").write.json(path)
    back = spark.read.schema("list bigint, cursor bigint, n bigint, total bigint").json(path)
    return quality.cursor_ranges(back, "cursor", "n", "total", ["list"])


def list_pages(spark, sf):
    """Events written as list pages of at most ``PAGE`` links each, and read back."""
    total = table(spark, sf, "events").agg(F.count("*")).scalar()
    link = F.concat(F.lit("https://api.osf.io/v2/preprints/"), "event_id", F.lit("/"))
    entry = F.struct("event_id", F.struct(link.alias("self")).alias("links"))
    pages = (
        table(spark, sf, "events")
        .groupBy(F.floor(F.col("event_id") / PAGE).alias("page_no"))
        .agg(F.sort_array(F.collect_list(entry)).alias("data"))
    )
    body = F.to_json(
        F.struct(
            F.transform("data", lambda d: F.struct(d["links"].alias("links"))).alias("data"),
            F.struct(total.alias("total"), F.lit(PAGE).alias("per_page")).alias("meta"),
        )
    )
    path = scratch_path(spark, "pages")
    pages.select("page_no", body.alias("value")).write.parquet(path)
    return landed.parse_list_pages(spark.read.parquet(path))


LINKS_SQL = f"""
    SELECT event_id // {PAGE} AS page_no,
      row_number() OVER (PARTITION BY event_id // {PAGE} ORDER BY event_id) - 1 AS pos,
      'https://api.osf.io/v2/preprints/' || event_id || '/' AS link
    FROM events"""


@query("page_links", LINKS_SQL)
def page_links(spark, sf):
    return landed.page_links(list_pages(spark, sf), "page_no")


@query(
    "osf_page_audit",
    f"""
    SELECT count(DISTINCT event_id // {PAGE}) AS n_pages, count(*) AS total,
      ceil(count(*) / {PAGE})::BIGINT AS announced_pages, count(DISTINCT event_id) AS n_links,
      count(*) FILTER (event_id % 7 = 0) AS n_missing,
      count(*) FILTER (event_id % 7 = 0) = 0 AS complete
    FROM events
    """,
)
def osf_page_audit(spark, sf):
    """A pull that failed on every seventh record."""
    pages = list_pages(spark, sf)
    landed_links = table(spark, sf, "events").where("event_id % 7 <> 0").select(
        F.concat(F.lit("https://api.osf.io/v2/preprints/"), "event_id", F.lit("/")).alias("link")
    )
    return quality.list_audit(pages, landed.page_links(pages, "page_no"), landed_links)


@query("capped_links", f"{LINKS_SQL} ORDER BY page_no, pos LIMIT 250")
def capped_links(spark, sf):
    links = landed.page_links(list_pages(spark, sf), "page_no")
    return ordinal.first_rows(links, ["page_no", "pos"], 250)


@query(
    "landing_dump",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, event_id, user_id, event_type, value, props,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
    FROM events
    """,
)
def landing_dump(spark, sf):
    path = scratch_path(spark, "landing")
    events = table(spark, sf, "events")
    payload = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    sinks.land_payload(payload, path, F.to_date(F.substring("ts", 1, 10)))
    # timestamps of payloads are text, to the microsecond
    back = spark.read.schema(
        "event_id bigint, ts string, user_id bigint, event_type string, value double, props string, "
        "ingest_date date"
    ).json(path)
    return back.withColumn("ingest_date", F.date_format("ingest_date", "yyyy-MM-dd"))


@query(
    "sink_append",
    """
    SELECT o_orderkey, o_orderstatus, o_custkey, o_totalprice, o_orderpriority,
      strftime(o_orderdate, '%Y-%m-%d') AS day
    FROM orders
    """,
)
def sink_append(spark, sf):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders")
    keys = ("o_orderstatus", "o_orderkey")
    # the second append repeats the first half and the third repeats everything
    half = orders.where(F.col("o_totalprice") < 250000)
    for batch in (half, orders, orders):
        sinks.keyed_append(batch, path, keys, "o_orderdate", "o_orderstatus")
    return spark.read.schema(orders.schema).parquet(path).select(
        "o_orderkey",
        "o_orderstatus",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )


@query(
    "incremental_updates",
    """
    SELECT doc_id::VARCHAR AS source_id, source,
      CASE WHEN doc_id % 3 = 0 THEN 'second ' ELSE 'first ' END || lang AS title,
      CASE WHEN doc_id % 3 = 0 THEN '2020-02-02' ELSE '2020-01-01' END AS modified, n_versions
    FROM documents,
      (SELECT count(*) + count(*) FILTER (doc_id % 3 = 0) AS n_versions FROM documents)
    """,
)
def incremental_updates(spark, sf):
    """The second pull brings changed records; a third repeats both. Readers see the newest."""
    path = scratch_path(spark, "versions")

    def pull(name, day, rows):
        return rows.select(
            F.col("doc_id").cast("string").alias("source_id"),
            F.concat(F.lit(f"{name} "), "lang").alias("title"),
            F.lit(dt.datetime(2020, day, day)).cast("timestamp").alias("modified_date"),
            "source",
        )

    docs = table(spark, sf, "documents")
    first, second = pull("first", 1, docs), pull("second", 2, docs.where("doc_id % 3 = 0"))
    for batch in (first, second, first.unionByName(second)):
        sinks.keyed_append(batch, path)
    held = spark.read.schema(first.schema).parquet(path)
    return sinks.newest(held).select(
        "source_id",
        "source",
        "title",
        F.date_format("modified_date", "yyyy-MM-dd").alias("modified"),
        held.agg(F.count("*")).scalar().alias("n_versions"),
    )


@query(
    "equal_stamps",
    """
    SELECT doc_id::VARCHAR AS source_id, source,
      CASE WHEN doc_id % 3 = 0 THEN 'corrected ' ELSE 'first ' END || lang AS title,
      CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS n_versions
    FROM documents
    """,
)
def equal_stamps(spark, sf):
    """Some records are corrected without a new date; both pulls are then repeated."""
    path = scratch_path(spark, "versions")

    def pull(name, day, rows):
        return rows.select(
            F.col("doc_id").cast("string").alias("source_id"),
            F.concat(F.lit(f"{name} "), "lang").alias("title"),
            F.lit(dt.datetime(2020, 1, 1)).cast("timestamp").alias("modified_date"),
            F.lit(dt.datetime(2020, 6, day)).cast("timestamp").alias("stored_date"),
            "source",
        )

    docs = table(spark, sf, "documents")
    first, second = pull("first", 1, docs), pull("corrected", 2, docs.where("doc_id % 3 = 0"))
    for batch in (first, second, pull("first", 3, docs), pull("corrected", 4, docs.where("doc_id % 6 = 0"))):
        sinks.keyed_append(batch, path)
    held = spark.read.schema(first.schema).parquet(path)
    versions = held.groupBy("source", "source_id").agg(F.count("*").alias("n_versions"))
    return (
        sinks.newest(held)
        .join(versions, ["source", "source_id"])
        .select("source_id", "source", "title", "n_versions")
    )


@query(
    "resumed_pulls",
    """
    WITH e AS (SELECT event_type AS source, event_id, ts FROM events),
    marks AS (SELECT source, max(ts) AS mark FROM e WHERE ts < '2024-01-12' GROUP BY source),
    runs AS (
      SELECT 1 AS run, source, event_id, ts FROM e WHERE ts < '2024-01-12'
      UNION ALL
      SELECT 2, source, event_id, ts FROM e LEFT JOIN marks USING (source)
      WHERE ts < '2024-01-20' AND (mark IS NULL OR ts >= mark)
      UNION ALL
      SELECT 3, source, event_id, ts FROM e LEFT JOIN marks USING (source) WHERE mark IS NULL OR ts >= mark)
    SELECT run, source, count(*) AS pulled, (SELECT count(*) FROM e WHERE e.source = runs.source) AS stored,
      (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') FROM e WHERE e.source = runs.source) AS mark
    FROM runs GROUP BY run, source
    """,
)
def resumed_pulls(spark, sf):
    """The second run fails after its append; the third starts from the mark of the first."""
    path = scratch_path(spark, "events")
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.col("event_id").cast("string").alias("source_id"),
        F.col("ts").cast("timestamp").alias("modified_date"),
    )
    until = [events.where(F.col("modified_date") < F.lit(day)) for day in ("2024-01-12", "2024-01-20")]
    first = marks.pull(until[0], path)
    second = stable(marks.changed_since(until[1], marks.high_water(events, path)))
    sinks.keyed_append(second, path)  # and no mark
    third = marks.pull(events, path)
    runs = [
        rows.groupBy("source").agg(F.count("*").alias("pulled")).withColumn("run", F.lit(run))
        for run, rows in enumerate((first, second, third), 1)
    ]
    stored = spark.read.schema(events.schema).parquet(path).groupBy("source").agg(
        F.count("*").alias("stored")
    )
    reached = marks.high_water(events, path).select(
        "source", F.date_format("mark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mark")
    )
    pulled = runs[0].unionByName(runs[1]).unionByName(runs[2])
    return pulled.join(stored, "source").join(reached, "source")


@query(
    "sink_table",
    """
    SELECT source, doc_id::VARCHAR AS source_id, 'urn:d:' || doc_id AS url, text AS abstract, 2 AS times
    FROM documents
    """,
)
def sink_table(spark, sf):
    """Create the table twice, append twice by name, and read it by name."""
    name = f"documents_{uuid.uuid4().hex}"
    path = scratch_path(spark, "table")
    rows = ingest.conform(
        table(spark, sf, "documents").select(
            "source",
            F.col("doc_id").cast("string").alias("source_id"),
            F.concat(F.lit("urn:d:"), "doc_id").alias("url"),
            F.col("text").alias("abstract"),
        )
    )
    for _ in range(2):
        sinks.create_document_table(spark, name, path)
        sinks.insert(rows, name)
    return (
        spark.table(name)
        .groupBy("source", "source_id", "url", "abstract")
        .agg(F.count("*").cast("int").alias("times"))
    )


@query(
    "ingest_rejects",
    """
    SELECT 'd' || doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'reject' ELSE 'document' END AS kind,
      CASE WHEN doc_id % 3 = 0 THEN 'unreadable line' ELSE '' END AS reason,
      CASE WHEN doc_id % 3 = 0 THEN '{"id":"d' || doc_id || '",' ELSE '' END AS raw,
      doc_id % 3 <> 1 AS has_file
    FROM documents WHERE doc_id % 3 < 2
    UNION ALL
    SELECT 'd' || doc_id, 'reject', 'no readable publish date', '', true
    FROM documents WHERE doc_id % 3 = 2
    """,
)
def ingest_rejects(spark, sf):
    """Every third line is cut, every third record has no date; nothing is lost."""
    path = scratch_path(spark, "arxiv")
    docs = table(spark, sf, "documents")
    start = F.concat(F.lit('{"id":"d'), "doc_id", F.lit('",'))
    dated = F.lit('"versions":[{"created":"Mon, 2 Apr 2007 19:18:42 GMT"}]}')
    kind = F.col("doc_id") % 3
    rest = F.when(kind == 0, "").when(kind == 1, dated).otherwise('"title":"t"}')
    docs.select(F.concat(start, rest).alias("value")).write.text(path)
    good, rejects = ingest.ingest(landed.read_arxiv(spark, path), ingest.normalise_arxiv)
    raw = F.coalesce(F.col(landed.CORRUPT), F.lit(""))
    return good.select(
        F.col("source_id").alias("id"),
        F.lit("document").alias("kind"),
        F.lit("").alias("reason"),
        F.lit("").alias("raw"),
        F.lit(False).alias("has_file"),
    ).unionByName(
        rejects.select(
            F.coalesce("source_id", F.regexp_extract(raw, '"id":"([^"]*)"', 1)).alias("id"),
            F.lit("reject").alias("kind"),
            F.col("reject_reason").alias("reason"),
            raw.alias("raw"),
            F.col("file").isNotNull().alias("has_file"),
        )
    )


REJECTED_LINES = """
    SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 3 = 1 THEN 'document' ELSE 'reject' END AS kind,
      CASE doc_id % 3 WHEN 0 THEN 'unreadable line' WHEN 2 THEN 'no readable publish date' ELSE '' END
        AS reason
    FROM documents
    """


@query("stream_rejects", REJECTED_LINES)
def stream_rejects(spark, sf):
    """The same broken lines as a stream of two pulls, the second repeating the first."""
    landing, target, progress = (scratch_path(spark, n) for n in ("landing", "table", "progress"))
    docs = table(spark, sf, "documents")
    start = F.concat(F.lit('{"id":"'), "doc_id", F.lit('",'))
    dated = F.lit('"versions":[{"created":"Mon, 2 Apr 2007 19:18:42 GMT"}]}')
    kind = F.col("doc_id") % 3
    rest = F.when(kind == 0, "").when(kind == 1, dated).otherwise('"title":"t"}')
    lines = docs.select(F.concat(start, rest).alias("value"), "doc_id")
    for pull in (lines.where("doc_id % 2 = 0"), lines):
        pull.select("value").write.mode("append").text(landing)
        feed = stream.landed_stream(spark, landing, S.ARXIV_RECORD)
        stream.ingest(feed, ingest.normalise_arxiv, target, progress).awaitTermination()
    good = spark.read.schema(S.DOCUMENT).parquet(target)
    rejects = spark.read.parquet(f"{target}/{stream.REJECTS}")
    line = F.regexp_extract(F.coalesce(F.col(landed.CORRUPT), F.lit("")), '"id":"([^"]*)"', 1)
    return good.select(
        F.col("source_id").alias("id"), F.lit("document").alias("kind"), F.lit("").alias("reason")
    ).unionByName(
        rejects.select(
            F.coalesce("source_id", line).alias("id"),
            F.lit("reject").alias("kind"),
            F.col("reject_reason").alias("reason"),
        ).distinct()
    )


@query(
    "bulk_append",
    "SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY o_orderstatus",
)
def bulk_append(spark, sf):
    """Without keys a rerun adds the rows again."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for _ in range(2):
        sinks.append(orders, path, "o_orderstatus")
    return (
        spark.read.schema(orders.schema)
        .parquet(path)
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n"))
    )


@query(
    "incremental_ingest",
    """
    SELECT event_type AS source, event_id::VARCHAR AS source_id, 'urn:e:' || event_id AS url,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS modified_date
    FROM events
    """,
)
def incremental_ingest(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    landing, target, progress = (
        scratch_path(spark, name) for name in ("landing", "table", "progress")
    )

    def normalise(raw):
        return raw.select(
            F.col("event_type").alias("source"),
            F.col("event_id").cast("string").alias("source_id"),
            F.concat(F.lit("urn:e:"), F.col("event_id").cast("string")).alias("url"),
            F.col("ts").alias("modified_date"),
        )

    # two pulls that overlap; the stream picks up what is new after each
    stop = F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz")
    start = F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    for pull in (events.where(F.col("ts") < stop), events.where(F.col("ts") >= start)):
        pull.write.mode("append").option(
            "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        ).json(landing)
        feed = stream.landed_stream(
            spark, landing, "event_id bigint, event_type string, ts timestamp"
        )
        stream.ingest(feed, normalise, target, progress).awaitTermination()
    back = spark.read.schema(
        "source string, source_id string, url string, modified_date timestamp"
    ).parquet(target)
    return back.withColumn(
        "modified_date", F.date_format("modified_date", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
