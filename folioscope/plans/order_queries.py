"""Queries on order and search: split, batches, pages, caps, phrase ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators import ordinal, search
from folioscope.plans.registry import query, table
from folioscope.session import scratch_path
from folioscope.sources import pages

PHRASE = "of the"


@query(
    "chrono_split",
    """
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
      <= count(*) OVER () - floor(count(*) OVER () * 0.1)::BIGINT THEN 'train' ELSE 'test' END AS split
    FROM orders
    """,
)
def chrono_split(spark, sf):
    orders = table(spark, sf, "orders")
    return ordinal.split_by_position(orders, ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "split"
    )


@query(
    "global_ordinal",
    """
    SELECT event_id, row_number() OVER (ORDER BY event_type, ts, event_id) AS ordinal FROM events
    """,
)
def global_ordinal(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return ordinal.with_ordinal(events, ["event_type", "ts", "event_id"]).select(
        "event_id", "ordinal"
    )


@query(
    "batch_assign",
    """
    SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS batch
    FROM orders
    """,
)
def batch_assign(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return ordinal.assign_batches(orders, ["o_orderdate", "o_orderkey"], 1000).select(
        "o_orderkey", "batch"
    )


@query(
    "keyset_page",
    """
    SELECT page, o_orderkey, o_custkey, day FROM (
      SELECT (row_number() OVER (ORDER BY day NULLS LAST, o_orderkey) - 1) // cut + 1 AS page, *
      FROM (SELECT o_orderkey, o_custkey,
          CASE WHEN o_orderkey % 4 <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders),
        (SELECT count(*) // 4 + 1 AS cut FROM orders))
    """,
)
def keyset_page(spark, sf):
    """The whole table in four pages by one numbering, dates that are missing included."""
    day = F.when(F.col("o_orderkey") % 4 != 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", day.alias("day"))
    size = orders.count() // 4 + 1
    numbered = ordinal.assign_batches(orders, ["day", "o_orderkey"], size, "page")
    return numbered.select((F.col("page") + 1).alias("page"), "o_orderkey", "o_custkey", "day")


@query(
    "page_walk",
    """
    WITH sized AS (SELECT count(*) // 5 + 1 AS size, count(*) // 16 + 1 AS per_file FROM orders),
    placed AS (
      SELECT o_orderkey, row_number() OVER (ORDER BY day NULLS LAST, o_orderkey) - 1 AS pos
      FROM (SELECT o_orderkey,
          CASE WHEN o_orderkey % 4 <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)),
    pages AS (SELECT *, pos // size AS page, pos // per_file AS file FROM placed, sized)
    SELECT page, o_orderkey, pos + 1 AS ordinal,
      (SELECT count(DISTINCT file) FROM pages q WHERE q.page = pages.page) AS n_files
    FROM pages
    """,
)
def page_walk(spark, sf):
    """The whole table page by page over its stored boundaries; each page opens its files only."""
    day = F.when(F.col("o_orderkey") % 4 != 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = table(spark, sf, "orders").select("o_orderkey", day.alias("day"))
    n, keys, path = orders.count(), ["day", "o_orderkey"], scratch_path(spark, "pages")
    pages.write_pages(orders, keys, path, n // 16 + 1)
    size, after, walked = n // 5 + 1, None, []
    while True:
        page = pages.read_page(spark, path, keys, size, after)
        last = page.agg(F.max_by(F.struct(*keys), "ordinal")).first()[0]
        if last is None:
            break
        files = page.agg(F.count_distinct("part")).scalar()
        walked.append(
            page.select(F.lit(len(walked)).cast("bigint").alias("page"), "o_orderkey", "ordinal", files.alias("n_files"))
        )
        after = tuple(last)
    return reduce(DataFrame.unionByName, walked)


@query(
    "match_phrase",
    r"""
    WITH words AS (
      SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:[''’][\p{L}\p{N}_]+)*') AS w
      FROM documents),
    positions AS (SELECT doc_id, unnest(list_zip(w, w[2:])) AS bigram FROM words)
    SELECT doc_id, count(*) AS freq FROM positions
    WHERE bigram[1] = 'of' AND bigram[2] = 'the' GROUP BY doc_id
    """,
)
def match_phrase(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return search.match_phrase(docs, "text", PHRASE).select("doc_id", "freq")


@query(
    "phrase_topk",
    r"""
    WITH words AS (
      SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:[''’][\p{L}\p{N}_]+)*') AS w
      FROM documents),
    stats AS (
      SELECT count(*) AS n, avg(len(w)) AS avg_words,
        count(*) FILTER (list_contains(w, 'of')) AS d1, count(*) FILTER (list_contains(w, 'the')) AS d2
      FROM words WHERE len(w) > 0),
    positions AS (SELECT doc_id, len(w) AS dl, unnest(list_zip(w, w[2:])) AS bigram FROM words),
    hits AS (
      SELECT doc_id, dl, count(*) AS freq FROM positions
      WHERE bigram[1] = 'of' AND bigram[2] = 'the' GROUP BY ALL)
    SELECT doc_id, freq, round(
      (ln(1 + (n - d1 + 0.5::DOUBLE) / (d1 + 0.5)) + ln(1 + (n - d2 + 0.5::DOUBLE) / (d2 + 0.5)))
      * freq * 2.2 / (freq + 1.2 * (0.25 + 0.75::DOUBLE * dl / avg_words)), 6) AS score,
      (SELECT count(*) FROM hits) AS total
    FROM hits, stats ORDER BY score DESC, doc_id LIMIT 10
    """,
)
def phrase_topk(spark, sf):
    counts = search.phrase_counts(table(spark, sf, "documents"), "doc_id", "text", PHRASE)
    scored = search.ranked_hits(counts, PHRASE).withColumn("score", F.round("score", 6))
    total = search.hit_total(scored).scalar()
    return search.top_hits(scored, "doc_id").select("doc_id", "freq", "score", total.alias("total"))
