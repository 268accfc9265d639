"""Queries on records: field functions, nested parts, conformed feeds, filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from folioscope.functions import dates as D
from folioscope.functions import records as R
from folioscope.functions.lookup import (
    ARXIV_CATEGORY_RENAMES,
    OSF_PROVIDERS,
    convert_categories,
    provider,
)
from folioscope.operators import filters, quality
from folioscope.plans import ingest
from folioscope.plans.oracle_sql import quoted
from folioscope.plans.registry import query, table
from folioscope.session import scratch_path
from folioscope.sources import landed

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def stamp(column):
    return F.date_format(column, STAMP)


def values_list(rules: dict[str, str]) -> str:
    return ", ".join(f"({i}, {quoted(k)}, {quoted(v)})" for i, (k, v) in enumerate(rules.items()))


@query("http_date", f"SELECT o_orderkey, strftime(o_orderdate, {SQL_STAMP}) AS created FROM orders")
def http_date(spark, sf):
    orders = table(spark, sf, "orders")
    written = F.concat(
        F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT")
    )
    return orders.select("o_orderkey", stamp(D.http_date(written)).alias("created"))


@query("iso_date", f"SELECT event_id, strftime(ts, {SQL_STAMP}) AS modified FROM events")
def iso_date(spark, sf):
    events = table(spark, sf, "events")
    # whole seconds are written without a fraction, as the archive does
    written = F.concat(
        F.regexp_replace(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""),
        F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(F.lit("")),
    )
    return events.select("event_id", stamp(D.iso_date(written)).alias("modified"))


@query(
    "first_last",
    r"""
    SELECT doc_id, regexp_extract(text, '^[^\n]*') AS first_version,
      regexp_extract(text, '[^\n]*$') AS last_version FROM documents
    """,
)
def first_last(spark, sf):
    docs = table(spark, sf, "documents")
    versions = F.split("text", "\n", -1)
    return docs.select(
        "doc_id",
        F.try_element_at(versions, F.lit(1)).alias("first_version"),
        F.try_element_at(versions, F.lit(-1)).alias("last_version"),
    )


_OLD = list(ARXIV_CATEGORY_RENAMES)


@query(
    "category_remap",
    f"""
    WITH rules(pos, old, new) AS (VALUES {values_list(ARXIV_CATEGORY_RENAMES)})
    SELECT doc_id, coalesce(new, 'math.' || source) || '|cs.CL|' || source AS categories
    FROM documents LEFT JOIN rules ON pos = doc_id % 20
    """,
)
def category_remap(spark, sf):
    docs = table(spark, sf, "documents")
    old = F.get(F.lit(_OLD), (F.col("doc_id") % 20).cast("int"))
    listed = F.concat_ws(
        " ", F.coalesce(old, F.concat(F.lit("math."), "source")), F.lit("cmp-lg"), "source"
    )
    return docs.select(
        "doc_id", F.array_join(convert_categories(F.split(listed, " ")), "|").alias("categories")
    )


_KEYS = list(OSF_PROVIDERS)
_BASE = "https://api.osf.io/v2/providers/preprints/"


@query(
    "provider_classify",
    f"""
    WITH rules(pos, key, name) AS (VALUES {values_list(OSF_PROVIDERS)}),
    asked AS (
      SELECT page_id, CASE WHEN page_id % 30 < 26
          THEN '{_BASE}' || coalesce((SELECT key FROM rules WHERE pos = page_id % 30), '') || '/'
        WHEN page_id % 30 = 26 THEN '{_BASE}osf/'
        WHEN page_id % 30 = 27 THEN '{_BASE}lissa/psyarxiv/'
        ELSE url END AS href FROM pages),
    hits AS (
      SELECT page_id, arg_max(name, pos) AS name FROM asked JOIN rules ON instr(href, key) > 0
      GROUP BY page_id)
    SELECT page_id, coalesce(name,
      CASE WHEN href LIKE '{_BASE}osf/%' THEN 'OSF' ELSE 'Unknown' END) AS source
    FROM asked LEFT JOIN hits USING (page_id)
    """,
)
def provider_classify(spark, sf):
    pages = table(spark, sf, "pages")
    turn = (F.col("page_id") % 30).cast("int")
    href = (
        F.when(turn < 26, F.concat(F.lit(_BASE), F.get(F.lit(_KEYS), turn), F.lit("/")))
        .when(turn == 26, F.lit(f"{_BASE}osf/"))
        .when(turn == 27, F.lit(f"{_BASE}lissa/psyarxiv/"))
        .otherwise(F.col("url"))
    )
    return pages.select("page_id", provider(href).alias("source"))


def contributors(words):
    """A contributor per word: every second one bibliographic, every third a deleted user."""

    def one(word, i):
        name = F.struct(word.alias("full_name"))
        data = F.when(i % 3 != 0, F.struct(name.alias("attributes")))
        errors = F.when(i % 3 == 0, F.array(F.struct(name.alias("meta"))))
        users = F.struct(data.alias("data"), errors.alias("errors"))
        return F.struct(
            F.struct((i % 2 == 0).alias("bibliographic")).alias("attributes"),
            F.struct(users.alias("users")).alias("embeds"),
        )

    return F.transform(words, one)


@query(
    "authors_flatten",
    """
    SELECT conv_id, turn, array_to_string(
      list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w, i: i % 2 = 1), '; ')
      AS authors
    FROM conversations
    """,
)
def authors_flatten(spark, sf):
    turns = table(spark, sf, "conversations")
    names = R.author_names(contributors(F.split("text", "[ \n]", -1)))
    return turns.select("conv_id", "turn", F.array_join(names, "; ").alias("authors"))


@query(
    "subject_flatten",
    """
    SELECT p_partkey, concat_ws('|', p_type || ' > ' || p_brand, p_type || ' > ' || p_brand, p_name)
      AS categories
    FROM part
    """,
)
def subject_flatten(spark, sf):
    part = table(spark, sf, "part")

    def chain(*names):
        return F.array(*[F.struct(F.lit("x").alias("id"), F.col(n).alias("text")) for n in names])

    subjects = F.array(
        chain("p_type", "p_brand", "p_name"), chain("p_type", "p_brand"), chain("p_name")
    )
    return part.select(
        "p_partkey", F.array_join(R.subject_paths(subjects), "|").alias("categories")
    )


@query(
    "date_fallback",
    f"""
    SELECT event_id, strftime(CASE WHEN value > 50 THEN ts ELSE ts - INTERVAL 1 DAY END, {SQL_STAMP})
      AS published
    FROM events
    """,
)
def date_fallback(spark, sf):
    events = table(spark, sf, "events")
    published = F.when(F.col("value") > 50, F.col("ts"))
    created = F.col("ts") - F.expr("INTERVAL 1 DAY")
    return events.select(
        "event_id", stamp(D.published_or_created(published, created)).alias("published")
    )


@query(
    "conform_union",
    """
    SELECT 'customer' AS source, c_custkey::VARCHAR AS source_id, 'urn:c:' || c_custkey AS url,
      c_name AS title, c_mktsegment AS categories FROM customer
    UNION ALL
    SELECT 'supplier', s_suppkey::VARCHAR, 'urn:s:' || s_suppkey, s_name, '-' FROM supplier
    """,
)
def conform_union(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("source"),
        F.col("c_custkey").cast("string").alias("source_id"),
        F.concat(F.lit("urn:c:"), "c_custkey").alias("url"),
        F.col("c_name").alias("title"),
        F.array("c_mktsegment").alias("categories"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.concat(F.lit("urn:s:"), "s_suppkey").alias("url"),
        F.col("s_suppkey").cast("string").alias("source_id"),
        F.col("s_name").alias("title"),
        F.lit("supplier").alias("source"),
        F.lit("").alias("abstract"),
    )
    both = ingest.conform(ingest.union_feeds(customers, suppliers))
    return both.select(
        "source",
        "source_id",
        "url",
        "title",
        F.coalesce(F.array_join("categories", "|"), "abstract", F.lit("-")).alias("categories"),
    )


@query(
    "created_range",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderdate::DATE BETWEEN DATE '1996-03-01' AND DATE '1998-08-31'
    """,
)
def created_range(spark, sf):
    orders = filters.created_between(
        table(spark, sf, "orders"), "o_orderdate", dt.date(1996, 3, 1), dt.date(1998, 8, 31)
    )
    return orders.select("o_orderkey", "o_custkey")


@query(
    "modified_since",
    "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'",
)
def modified_since(spark, sf):
    events = table(spark, sf, "events")
    return filters.modified_since(events, "ts", dt.datetime(2024, 1, 20, 12)).select(
        "event_id", "event_type"
    )


@query(
    "duplicate_ids",
    """
    SELECT count(DISTINCT text) AS n_unique, count(*) - count(DISTINCT text) AS n_dupes
    FROM documents
    """,
)
def duplicate_ids(spark, sf):
    ids = table(spark, sf, "documents").select(F.sha2("text", 256).alias("id"))
    return quality.duplicate_ids(ids, "id")


def arxiv_json():
    """Documents written as arXiv records: one JSON object per line."""
    old = F.get(F.lit(_OLD), (F.col("doc_id") % 20).cast("int"))

    def created(days: int):
        at = F.date_add(F.lit(dt.date(2007, 4, 1)), (F.col("doc_id") % 5000 + days).cast("int"))
        return F.struct(
            F.concat(F.date_format(at, "EEE, d MMM yyyy"), F.lit(" 18:13:24 GMT")).alias("created")
        )

    return F.to_json(
        F.struct(
            F.concat(F.lit("0704."), F.format_string("%06d", "doc_id")).alias("id"),
            F.concat_ws(" ", old, F.lit("cs.CL"), "lang").alias("categories"),
            F.array(created(0), created(9), created(4)).alias("versions"),
            F.concat(F.lit("Title of\n  "), "source").alias("title"),
            F.col("text").alias("abstract"),
            F.concat(F.lit("A. "), "source").alias("authors"),
        )
    ).alias("value")


@query(
    "normalise_arxiv",
    f"""
    WITH rules(pos, old, new) AS (VALUES {values_list(ARXIV_CATEGORY_RENAMES)})
    SELECT 'arXiv' AS source, '0704.' || printf('%06d', doc_id) AS source_id,
      'https://arxiv.org/abs/0704.' || printf('%06d', doc_id) AS url,
      strftime(DATE '2007-04-01' + (doc_id % 5000)::INT, '%Y-%m-%d 18:13:24') AS publish_date,
      strftime(DATE '2007-04-01' + (doc_id % 5000 + 4)::INT, '%Y-%m-%d 18:13:24') AS modified_date,
      'Title of ' || documents.source AS title,
      array_to_string(list_transform(string_split(
        CASE WHEN suffix(text, chr(10)) THEN left(text, length(text) - 1) ELSE text END, chr(10)),
        lambda line: trim(line, ' ' || chr(9))), ' ') AS abstract,
      'A. ' || documents.source AS authors,
      concat_ws('|', new, 'cs.CL', lang) AS categories
    FROM documents LEFT JOIN rules ON pos = doc_id % 20
    """,
)
def normalise_arxiv(spark, sf):
    path = scratch_path(spark, "arxiv")
    table(spark, sf, "documents").select(arxiv_json()).write.text(path)
    docs = ingest.normalise_arxiv(landed.read_arxiv(spark, path))
    return docs.select(
        "source",
        "source_id",
        "url",
        F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss").alias("publish_date"),
        F.date_format("modified_date", "yyyy-MM-dd HH:mm:ss").alias("modified_date"),
        "title",
        "abstract",
        F.array_join("authors", "|").alias("authors"),
        F.array_join("categories", "|").alias("categories"),
    )


def osf_json():
    """Pages written as OSF records: one JSON object per line."""
    turn = (F.col("page_id") % 30).cast("int")
    href = F.concat(F.lit(_BASE), F.coalesce(F.get(F.lit(_KEYS), turn), F.lit("osf")), F.lit("/"))
    day = F.date_format(
        F.date_add(F.lit(dt.date(2016, 7, 13)), (F.col("page_id") % 1400).cast("int")),
        "yyyy-MM-dd'T'05:06:07",
    )
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    words = F.split(title, " ", -1)

    def user(word, i):
        name = F.to_json(F.struct(word.alias("full_name")))
        found = F.concat(F.lit('{"data":{"attributes":'), name, F.lit("}}"))
        gone = F.concat(F.lit('{"errors":[{"meta":'), name, F.lit("}]}"))
        listed = F.when(i % 2 == 0, "true").otherwise("false")
        return F.concat(
            F.lit('{"attributes":{"bibliographic":'),
            listed,
            F.lit('},"embeds":{"users":'),
            F.when(i % 3 == 0, gone).otherwise(found),
            F.lit("}}"),
        )

    people = F.array_join(F.transform(words, user), ",")
    subject = F.to_json(
        F.array(
            F.array(
                *[
                    F.struct(F.lit(f"s{n}").alias("id"), text.alias("text"))
                    for n, text in enumerate((F.lit("Top"), F.get(words, F.lit(0)), F.lit("Leaf")))
                ]
            )
        )
    )
    fields = F.to_json(
        F.struct(
            title.alias("title"),
            F.col("html").alias("description"),
            F.when(F.col("page_id") % 4 != 0, F.concat(day, F.lit(".250000"))).alias("date_published"),
            day.alias("date_created"),
            F.concat(day, F.lit("Z")).alias("date_modified"),
        )
    )
    return F.concat(
        F.lit('{"data":{"id":"p'),
        F.col("page_id").cast("string"),
        F.lit('","links":'),
        F.to_json(F.struct(F.col("url").alias("html"))),
        F.lit(',"attributes":'),
        F.regexp_replace(fields, r"\}\z", ""),
        F.lit(',"subjects":'),
        subject,
        F.lit('},"relationships":{"provider":{"links":{"related":{"href":"'),
        href,
        F.lit('"}}}},"embeds":{"contributors":{"data":['),
        people,
        F.lit("]}}}}"),
    ).alias("value")


@query(
    "normalise_osf",
    f"""
    WITH rules(pos, key, name) AS (VALUES {values_list(OSF_PROVIDERS)}),
    titled AS (
      SELECT *, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
        DATE '2016-07-13' + (page_id % 1400)::INT AS day FROM pages)
    SELECT coalesce(name, 'OSF') AS source, 'p' || page_id AS source_id, url,
      strftime(day, '%Y-%m-%d 05:06:07') || CASE WHEN page_id % 4 <> 0 THEN '.250' ELSE '.000' END
        AS publish_date,
      strftime(day, '%Y-%m-%d 05:06:07.000') AS modified_date, title, html AS abstract,
      array_to_string(list_filter(string_split(title, ' '), lambda w, i: i % 2 = 1), '|') AS authors,
      'Top > ' || string_split(title, ' ')[1] AS categories
    FROM titled LEFT JOIN rules ON pos = page_id % 30
    """,
)
def normalise_osf(spark, sf):
    path = scratch_path(spark, "osf")
    table(spark, sf, "pages").select(osf_json()).write.text(path)
    docs = ingest.normalise_osf(landed.read_osf(spark, path))
    return docs.select(
        "source",
        "source_id",
        "url",
        F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss.SSS").alias("publish_date"),
        F.date_format("modified_date", "yyyy-MM-dd HH:mm:ss.SSS").alias("modified_date"),
        "title",
        "abstract",
        F.array_join("authors", "|").alias("authors"),
        F.array_join("categories", "|").alias("categories"),
    )
