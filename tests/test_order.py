import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioscope.operators import filters, ordinal, search
from folioscope.sources import pages


def days(spark, rows):
    return spark.createDataFrame(rows, "id bigint, day date")


ROWS = [(i, dt.date(2020, 1, 1 + (0 if i % 3 else i % 7))) for i in range(200)] + [(999, None)]


def expected(rows):
    return [r[0] for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or dt.date.max, r[0]))]


@pytest.mark.parametrize("partitions", [1, 5])
def test_ordinal_numbers_every_row_once(spark, partitions):
    numbered = ordinal.with_ordinal(days(spark, ROWS), ["day", "id"], partitions=partitions)
    got = [(r["ordinal"], r["id"]) for r in numbered.orderBy("ordinal").collect()]
    assert got == list(enumerate(expected(ROWS), 1))


@pytest.mark.parametrize("share", [0.0, 0.1, 0.333, 1.0])
def test_split_by_position(spark, share):
    marked = ordinal.split_by_position(days(spark, ROWS), ["day", "id"], share)
    train = {r["id"] for r in marked.where("split = 'train'").collect()}
    cut = len(ROWS) - int(len(ROWS) * share)
    assert train == set(expected(ROWS)[:cut])
    assert marked.where("split = 'test'").count() == len(ROWS) - cut


def test_batches(spark):
    sizes = ordinal.assign_batches(days(spark, ROWS), ["day", "id"], 60).groupBy("batch").count()
    assert {r["batch"]: r["count"] for r in sizes.collect()} == {0: 60, 1: 60, 2: 60, 3: 21}


def test_pages_cover_the_table_and_its_nulls(spark):
    rows = days(spark, ROWS).withColumn("day", F.expr("CASE WHEN id % 3 > 0 THEN day END"))
    want = [r["id"] for r in rows.orderBy(*ordinal.order_columns(["day", "id"])).collect()]
    seen, last = [], None
    while page := ordinal.page_after(rows, ["day", "id"], 45, last).collect():
        seen += [r["id"] for r in page]
        last = (page[-1]["day"], page[-1]["id"])
    assert seen == want and len(set(seen)) == len(ROWS)


def test_created_between_includes_both_days(spark):
    rows = spark.createDataFrame(
        [(i, dt.datetime(2020, 1, 1) + dt.timedelta(hours=6 * i)) for i in range(40)],
        "id bigint, created timestamp",
    )
    first, last = dt.date(2020, 1, 3), dt.date(2020, 1, 4)
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(filters.created_between(rows, "created", first, last)) == list(range(8, 16))
    assert ids(filters.created_between(rows, "created", None, first)) == list(range(12))
    assert ids(filters.created_between(rows, "created", last)) == list(range(12, 40))
    assert ids(filters.modified_since(rows, "created", last)) == list(range(12, 40))


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.current_timestamp().alias("created")).write.parquet(path)
    found = filters.created_between(spark.read.parquet(path), "created", dt.date(2020, 1, 1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created" in plan


def test_page_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    after = (dt.datetime(1998, 1, 1), 5)
    page = ordinal.page_after(orders, ["o_orderdate", "o_orderkey"], 10, after)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_split_on_timestamps_with_a_hot_date(spark):
    hot = dt.datetime(2020, 3, 29, 2, 30, 0, 123456)
    rows = [(i, hot if i % 3 else hot + dt.timedelta(minutes=i)) for i in range(300)]
    table = spark.createDataFrame(rows, "id bigint, at timestamp")
    marked = ordinal.split_by_position(table, ["at", "id"], 0.5)
    train = {r["id"] for r in marked.where("split = 'train'").collect()}
    assert train == {i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))[:150]}


TEXTS = [
    (1, "The Reinforcement learning of reinforcement LEARNING."),
    (2, "reinforcement-learning"),
    (3, "learning reinforcement"),
    (4, "reinforcement's learning"),
    (5, "deep reinforcement learning " + "x " * 50),
    (6, None),
]


def test_phrase_search(spark):
    docs = spark.createDataFrame(TEXTS, "id bigint, t string")
    hits = search.match_phrase(docs, "t", "Reinforcement Learning")
    assert {r["id"]: r["freq"] for r in hits.collect()} == {1: 2, 2: 1, 5: 1}
    scored = search.phrase_scores(docs, "t", "reinforcement learning")
    assert [r["id"] for r in search.top_hits(scored, "id").collect()] == [1, 2, 5]
    assert search.hit_total(hits).first()["total"] == 3


def test_phrase_may_overlap_itself(spark):
    docs = spark.createDataFrame([(1, "a a a b"), (2, "a")], "id bigint, t string")
    hits = search.match_phrase(docs, "t", "a a").collect()
    assert [(r["id"], r["freq"], r["n_words"]) for r in hits] == [(1, 2, 4)]


def test_query_of_pages_has_no_global_limit(spark, monkeypatch):
    from folioscope.plans import order_queries  # noqa: F401  registers the query
    from folioscope.plans.registry import QUERIES

    def refuse(*args):
        raise AssertionError("a page of a whole table is one task")

    monkeypatch.setattr(ordinal, "page_after", refuse)
    rows = QUERIES["keyset_page"](spark, "/root/testdata/sf0.001").collect()
    assert {r.page for r in rows} == {1, 2, 3, 4}


@pytest.mark.parametrize("n", [0, 1, 5, 40, 199, 200, 500])
def test_highest_rows_without_one_task(spark, n):
    rows = [(f"t{i:03}", 1 + (i * 37) % 23 if i % 2 else 1) for i in range(200)]
    frame = spark.createDataFrame(rows, "term string, total bigint").repartition(5)
    got = ordinal.highest(frame, "total", "term", n)
    assert "_step" not in got.columns
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:n]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("per_file, size", [(20, 45), (50, 7), (500, 60)])
def test_pages_open_only_their_files(spark, tmp_path, per_file, size):
    rows = days(spark, ROWS).withColumn("day", F.expr("CASE WHEN id % 3 > 0 THEN day END"))
    keys, path = ["day", "id"], str(tmp_path / "t")
    pages.write_pages(rows, keys, path, per_file)
    want = [r["id"] for r in rows.orderBy(*ordinal.order_columns(keys)).collect()]
    seen, last = [], None
    while page := pages.read_page(spark, path, keys, size, last).orderBy("ordinal").collect():
        at = len(seen)
        seen += [r["id"] for r in page]
        files = {r["part"] for r in page}
        assert files == set(range(at // per_file, (len(seen) - 1) // per_file + 1))
        last = (page[-1]["day"], page[-1]["id"])
    assert seen == want
    # a key that no row has begins behind the rows before it
    assert pages.read_page(spark, path, keys, 3, (dt.date(1999, 1, 1), 0)).agg(F.min("ordinal")).first()[0] == 1
