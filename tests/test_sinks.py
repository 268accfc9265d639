import datetime as dt
import json

import pytest

from folioscope import schema as S
from folioscope.plans import ingest
from folioscope.sources import marks, sinks
from folioscope.streaming import ingest as stream
from tests.test_records import ARXIV, land

ROW = "source string, source_id string, modified_date timestamp, title string"


def batch(spark, *rows):
    return spark.createDataFrame(
        [(s, i, dt.datetime(2020, 1, d), t) for s, i, d, t in rows], ROW
    )


def held(spark, path):
    rows = spark.read.schema(ROW).parquet(path).collect()
    return sorted((r["source"], r["source_id"] or "", r["title"]) for r in rows)


def newest(spark, path):
    rows = sinks.newest(spark.read.schema(ROW).parquet(path)).collect()
    return sorted((r["source"], r["source_id"] or "", r["title"]) for r in rows)


def test_keyed_append_keeps_versions_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "docs")
    first = batch(
        spark, ("a", "01", 1, "old"), ("a", "01", 2, "new"), ("b", None, 1, "x"), ("b", None, 1, "y")
    )
    for _ in range(2):
        sinks.keyed_append(first, path)
    want = [("a", "01", "new"), ("a", "01", "old"), ("b", "", "x"), ("b", "", "y")]
    assert held(spark, path) == want
    assert newest(spark, path) == [want[0], *want[2:]]
    later = batch(spark, ("a", "01", 9, "later"), ("a", "1", 1, "other"), ("a", "01", 1, "old"))
    for _ in range(2):
        sinks.keyed_append(later, path)
    assert held(spark, path) == sorted([*want, ("a", "01", "later"), ("a", "1", "other")])
    assert newest(spark, path) == [("a", "01", "later"), ("a", "1", "other"), *want[2:]]


def test_stream_keeps_broken_lines_with_their_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", [ARXIV[0]], "a.json")
    (tmp_path / "in" / "b.json").write_text('{"id": "1", \n{"id": "2"}\n')
    table, progress, rejects = (str(tmp_path / n) for n in ("table", "progress", "rejects"))
    for _ in range(2):
        feed = stream.landed_stream(spark, str(tmp_path / "in"), S.ARXIV_RECORD)
        stream.ingest(
            feed, ingest.normalise_arxiv, table, progress, rejects=rejects
        ).awaitTermination()
    assert [r["source_id"] for r in spark.read.schema(S.DOCUMENT).parquet(table).collect()] == ["0704.0010"]
    got = {(r["reject_reason"], r["_corrupt_record"]) for r in spark.read.parquet(rejects).collect()}
    assert got == {("unreadable line", '{"id": "1", '), ("no readable publish date", None)}
    assert all(r["file"].endswith("b.json") for r in spark.read.parquet(rejects).collect())


def test_plain_append_repeats(spark, tmp_path):
    path = str(tmp_path / "docs")
    for _ in range(2):
        sinks.append(batch(spark, ("a", "1", 1, "t")), path)
    assert held(spark, path) == [("a", "1", "t")] * 2


def test_document_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "table")
    for _ in range(2):
        sinks.create_document_table(spark, "preprint_test", path)
    try:
        assert sorted(spark.table("preprint_test").columns) == sorted(S.DOCUMENT.names)
        assert spark.table("preprint_test").count() == 0
    finally:
        spark.sql("DROP TABLE preprint_test")


def test_stream_equals_batch_and_reruns_add_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run():
        feed = stream.landed_stream(spark, str(tmp_path / "in"), S.ARXIV_RECORD, max_files=1)
        stream.ingest(feed, ingest.normalise_arxiv, table, progress).awaitTermination()

    one = {**ARXIV[0], "id": "0704.0001"}
    land(tmp_path / "in", [ARXIV[0], one], "a.json")
    land(tmp_path / "in", [ARXIV[0]], "b.json")
    run()
    run()
    land(tmp_path / "in", [one, {**one, "id": "0704.0002"}], "c.json")
    run()
    got = spark.read.schema(S.DOCUMENT).parquet(table)
    assert sorted(r["source_id"] for r in got.collect()) == ["0704.0001", "0704.0002", "0704.0010"]
    raw = spark.read.schema(S.ARXIV_RECORD).json(str(tmp_path / "in"))
    same = ["source", "source_id", "url", "publish_date", "title", "categories"]
    expected = ingest.normalise_arxiv(raw).select(same).distinct()
    assert got.select(same).exceptAll(expected).isEmpty()
    assert expected.exceptAll(got.select(same)).isEmpty()


def test_payloads_land_by_date(spark, tmp_path):
    path = str(tmp_path / "landing")
    payload = spark.createDataFrame([(json.dumps({"a": 1}),)], "body string")
    sinks.land_payload(payload, path)
    sinks.land_payload(payload, path)
    assert spark.read.json(path).count() == 2
    assert "ingest_date" in spark.read.json(path).columns


def test_xml_pages_stream_into_the_table(spark, tmp_path):
    from pyspark.sql import functions as F

    from tests.test_records import OAI

    (tmp_path / "in").mkdir()
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def normalise(raw):
        return raw.select(
            F.lit("arXiv").alias("source"),
            F.col("metadata.arXiv.id").alias("source_id"),
            F.lit(None).cast("timestamp").alias("modified_date"),
            F.col("metadata.arXiv.title").alias("title"),
        )

    for cursor in (0, 2):
        (tmp_path / "in" / f"{cursor}.xml").write_text(OAI.format(cursor=cursor, token="t"))
        feed = stream.oai_stream(spark, str(tmp_path / "in"), S.OAI_RECORD)
        stream.ingest(feed, normalise, table, progress).awaitTermination()
    assert held(spark, table) == [
        ("arXiv", "0704.0010", "One & two"),
        ("arXiv", "0704.0020", "Three"),
    ]


def test_a_change_under_an_equal_stamp_is_a_version(spark, tmp_path):
    path = str(tmp_path / "docs")
    first = batch(spark, ("a", "1", 1, "old"), ("a", "2", 1, "same"))
    for rows in (first, batch(spark, ("a", "1", 1, "corrected")), first):
        sinks.keyed_append(rows, path)
    assert held(spark, path) == [("a", "1", "corrected"), ("a", "1", "old"), ("a", "2", "same")]


def test_versions_stored_last_win_among_equal_stamps(spark):
    day = dt.datetime(2020, 1, 1)
    rows = [("a", "1", day, dt.datetime(2020, 2, d), t) for d, t in ((1, "zzz"), (2, "aaa"))]
    frame = spark.createDataFrame(
        rows, "source string, source_id string, modified_date timestamp, stored_date timestamp, title string"
    )
    assert [r["title"] for r in sinks.newest(frame).collect()] == ["aaa"]


def test_a_batch_that_was_not_confirmed_is_looked_up_in_the_table(spark, tmp_path, monkeypatch):
    rows = batch(spark, ("a", "1", 1, "x"), ("b", "2", 1, "y"))

    def fail(*args):
        raise OSError("lost")

    for name, step in (("before", "append"), ("after", "confirm")):
        path = str(tmp_path / name)
        with monkeypatch.context() as patch:
            patch.setattr(sinks if step == "append" else sinks.Ledger, step, fail)
            with pytest.raises(OSError):
                sinks.keyed_append(rows, path)
        for _ in range(2):
            sinks.keyed_append(rows, path)
        assert held(spark, path) == [("a", "1", "x"), ("b", "2", "y")]


def test_a_table_without_ledger_gets_one(spark, tmp_path):
    path = str(tmp_path / "docs")
    sinks.append(batch(spark, ("a", "1", 1, "x")), path)
    sinks.keyed_append(batch(spark, ("a", "1", 1, "x"), ("a", "2", 1, "y")), path)
    assert held(spark, path) == [("a", "1", "x"), ("a", "2", "y")]


def test_a_batch_reads_only_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "docs")
    many = batch(spark, *[("a", str(i), 1, "x") for i in range(200)])
    sinks.keyed_append(many, path)
    ledger = sinks.Ledger(path, many.schema, (*sinks.DOCUMENT_KEY, "modified_date"), sinks.LEDGER_BUCKETS)
    rows = spark.read.schema(ledger.schema).parquet(f"{path}/{sinks.LEDGER}")
    asked = ledger.tagged(batch(spark, ("a", "7", 1, "x"))).select(ledger.names)

    def folders(frame):
        return {r[0].rsplit("/", 2)[1] for r in frame.select("_metadata.file_path").distinct().collect()}

    read = ledger.touched(rows, asked)
    assert len(folders(rows)) == sinks.LEDGER_BUCKETS and len(folders(read)) == 1
    sinks.keyed_append(batch(spark, ("a", "7", 1, "x")), path)
    assert held(spark, path) == sorted(("a", str(i), "x") for i in range(200))


def test_marks_advance_after_the_append(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    feed = batch(spark, ("a", "1", 1, "x"), ("a", "2", 5, "y"), ("b", "3", 2, "z"))
    assert marks.pull(feed, path).count() == 3
    later = feed.unionByName(batch(spark, ("a", "4", 6, "new"), ("c", "5", 1, "other")))
    with monkeypatch.context() as patch:
        patch.setattr(marks, "advance", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            marks.pull(later, path)
    # the instant of each mark comes again, what lies before it does not
    assert sorted(r["source_id"] for r in marks.pull(later, path).collect()) == ["2", "3", "4", "5"]
    assert sorted(r["source_id"] for r in marks.pull(later, path).collect()) == ["3", "4", "5"]
    assert len(held(spark, path)) == 5
    # a change of the instant of the mark that comes later is not lost
    marks.pull(later.unionByName(batch(spark, ("a", "9", 6, "late"))), path)
    assert len(held(spark, path)) == 6


def test_stream_judges_by_default(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.json").write_text('{"id": "1", \n{"id": "2"}\n')
    table, progress = (str(tmp_path / n) for n in ("table", "progress"))
    feed = stream.landed_stream(spark, str(tmp_path / "in"), S.ARXIV_RECORD)
    stream.ingest(feed, ingest.normalise_arxiv, table, progress).awaitTermination()
    rejects = spark.read.parquet(f"{table}/{stream.REJECTS}")
    assert {r["reject_reason"] for r in rejects.collect()} == {"unreadable line", "no readable publish date"}
