import datetime as dt
import json

from pyspark.sql import functions as F

from folioscope import schema as S
from folioscope.functions import dates as D
from folioscope.functions.lookup import provider
from folioscope.operators.quality import page_count, split_rejects
from folioscope.plans import ingest
from folioscope.sources import landed

ARXIV = [
    {
        "id": "0704.0010",
        "categories": "cmp-lg cs.CL",
        "versions": [
            {"created": "Mon, 2 Apr 2007 19:18:42 GMT"},
            {"created": "Tue, 24 Jul 2007 20:10:27 GMT"},
        ],
        "title": "A title\n  in two\n\nparts\r\nmore",
        "abstract": "  Text\n",
        "authors": "B. Author and C. Author",
    },
    {"id": "x/1", "categories": "math.AG", "versions": [], "title": "t", "abstract": "", "authors": "A"},
]


def osf(pid, href, published, description, subjects, people):
    return {
        "data": {
            "id": pid,
            "links": {"html": f"https://osf.io/{pid}/"},
            "attributes": {
                "title": "T " + pid,
                "description": description,
                "date_published": published,
                "date_created": "2018-03-01T10:00:00",
                "date_modified": "2019-01-02T03:04:05.678901Z",
                "subjects": [[{"id": str(i), "text": t} for i, t in enumerate(c)] for c in subjects],
            },
            "relationships": {"provider": {"links": {"related": {"href": href}}}},
            "embeds": {"contributors": {"data": people}},
        }
    }


def person(name, listed=True, deleted=False):
    user = (
        {"errors": [{"meta": {"full_name": name}}]}
        if deleted
        else {"data": {"attributes": {"full_name": name}}}
    )
    return {"attributes": {"bibliographic": listed}, "embeds": {"users": user}}


BASE = "https://api.osf.io/v2/providers/preprints/"
OSF = [
    osf("a1", BASE + "psyarxiv/", "2018-03-05T11:22:33.5", None,
        [["Business", "Accounting", "Audit"], ["Business", "Accounting", "Tax"], ["Law"]],
        [person("Ann"), person("Bo", listed=False), person("Gone", deleted=True)]),
    osf("a2", BASE + "osf/", None, "", [], []),
    osf("a3", "https://elsewhere.org/", None, "d", [["One"]], [person("Cy")]),
]


def land(tmp_path, rows, name="osf-beginning.json"):
    path = tmp_path / name
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    return str(path)


def test_arxiv_records(spark, tmp_path):
    docs = ingest.normalise_arxiv(landed.read_arxiv(spark, land(tmp_path, ARXIV)))
    assert docs.columns == S.DOCUMENT.names
    one, two = docs.orderBy("source_id").collect()
    assert one["source_id"] == "0704.0010" and one["source"] == "arXiv"
    assert one["url"] == "https://arxiv.org/abs/0704.0010"
    assert one["publish_date"] == dt.datetime(2007, 4, 2, 19, 18, 42)
    assert one["modified_date"] == dt.datetime(2007, 7, 24, 20, 10, 27)
    assert one["title"] == "A title in two  parts more" and one["abstract"] == "Text"
    assert one["categories"] == ["cs.CL", "cs.CL"]
    assert one["authors"] == ["B. Author and C. Author"]
    assert one["keywords"] is None and one["doc_vector"] is None
    assert two["publish_date"] is None and two["abstract"] is None


def test_rows_without_a_date_are_rejected_with_a_reason(spark, tmp_path):
    docs = ingest.normalise_arxiv(landed.read_arxiv(spark, land(tmp_path, ARXIV)))
    good, rejects = split_rejects(docs)
    assert [r["source_id"] for r in good.collect()] == ["0704.0010"]
    assert [r["reject_reason"] for r in rejects.collect()] == ["no readable publish date"]


def test_vectors_of_another_length_are_rejected(spark, tmp_path):
    docs = ingest.normalise_osf(landed.read_osf(spark, land(tmp_path, OSF)))
    size = F.when(F.col("source_id") == "a1", 3).otherwise(S.DOC_VECTOR_DIMS)
    docs = docs.withColumn("doc_vector", F.array_repeat(F.lit(1.0).cast("float"), size))
    good, rejects = split_rejects(docs)
    assert sorted(r["source_id"] for r in good.collect()) == ["a2", "a3"]
    assert [r["reject_reason"] for r in rejects.collect()] == ["vector is not of length 256"]


def test_osf_records(spark, tmp_path):
    docs = ingest.normalise_osf(landed.read_osf(spark, land(tmp_path, OSF)))
    one, two, three = docs.orderBy("source_id").collect()
    assert [r["source"] for r in (one, two, three)] == ["PsyArXiv", "OSF", "Unknown"]
    assert one["categories"] == ["Business > Accounting", "Business > Accounting", "Law"]
    assert one["authors"] == ["Ann", "Gone"]
    assert one["publish_date"] == dt.datetime(2018, 3, 5, 11, 22, 33, 500000)
    assert two["publish_date"] == dt.datetime(2018, 3, 1, 10)
    assert one["modified_date"] == dt.datetime(2019, 1, 2, 3, 4, 5, 678901)
    assert one["abstract"] is None and two["abstract"] is None and two["authors"] is None


def test_last_provider_rule_wins(spark):
    urls = [BASE + "psyarxiv/socarxiv", BASE + "socarxiv/psyarxiv", "x/marxiv", "osf"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(provider(F.col("u")))
    assert [r[0] for r in rows.collect()] == ["SocArXiv", "SocArXiv", "MarXiv", "Unknown"]


def test_dates_that_do_not_parse_are_null(spark):
    cases = ["Sun, 2 Apr 2007 19:18:42 GMT", "2 Apr 2007", "", None]
    rows = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in rows.select(D.http_date(F.col("t"))).collect()]
    assert got == [dt.datetime(2007, 4, 2, 19, 18, 42), None, None, None]


def test_broken_lines_are_kept_apart(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"id": "1"}\n{"id": \n')
    rows = landed.read_json_lines(spark, str(path), "id string").orderBy("id").collect()
    assert [(r["id"], r[landed.CORRUPT]) for r in rows] == [(None, '{"id": '), ("1", None)]


def test_beginning_file_comes_first(spark):
    names = ["/osf-pulls/osf-2017-01-01-to-x.json", "/osf-pulls/osf-beginning-to-2016.json", "/d/osf-2016-02.json"]
    rows = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r["p"] for r in rows.orderBy(landed.file_rank(F.col("p"))).collect()]
    assert got == [names[1], names[2], names[0]]


def test_list_pages(spark):
    body = json.dumps(
        {"data": [{"links": {"self": "u1"}}, {"links": {"self": "u2"}}],
         "meta": {"total": 25, "per_page": 10}, "links": {"next": None}}
    )
    pages = landed.parse_list_pages(spark.createDataFrame([(1, body)], "no int, value string"))
    links = landed.page_links(pages, "no").orderBy("pos").collect()
    assert [tuple(r) for r in links] == [(1, 0, "u1"), (1, 1, "u2")]
    pages_needed = pages.select(page_count(F.col("page.meta.total"), F.col("page.meta.per_page")))
    assert pages_needed.first()[0] == 3


OAI = """<?xml version="1.0"?><OAI-PMH><ListRecords>
<record><header><identifier>oai:1</identifier></header>
<metadata><arXiv><id>0704.0010</id><title>One &amp; two</title></arXiv></metadata></record>
<record><metadata><arXiv><id>0704.0020</id><title>Three</title></arXiv></metadata></record>
<resumptionToken cursor="{cursor}" completeListSize="4">{token}</resumptionToken>
</ListRecords></OAI-PMH>"""


def test_oai_pages(spark, tmp_path):
    from folioscope.operators.quality import page_audit

    (tmp_path / "p1.xml").write_text(OAI.format(cursor=0, token="t1"))
    records = landed.read_oai_records(spark, str(tmp_path))
    tokens = landed.read_oai_tokens(spark, str(tmp_path))
    got = {tuple(r) for r in landed.oai_ids(records).collect()}
    assert got == {("0704.0010", "One & two"), ("0704.0020", "Three")}
    assert not page_audit(records, tokens).first()["complete"]
    (tmp_path / "p2.xml").write_text(OAI.format(cursor=2, token=""))
    records = landed.read_oai_records(spark, str(tmp_path))
    audit = page_audit(records, landed.read_oai_tokens(spark, str(tmp_path))).first()
    assert audit["complete"] and audit["n_records"] == 4 and audit["last_cursor"] == 2


def test_cursor_ranges(spark):
    from folioscope.operators import quality

    rows = [("a", 0, 3, 20), ("a", 3, 3, 20), ("a", 3, 3, 20), ("a", 10, 5, 20), ("a", 12, 5, 20), ("a", 17, 5, 20)]
    rows += [("b", 0, 4, 4), ("c", 2, 1, 4)]
    pages = spark.createDataFrame(rows, "list string, cursor bigint, n bigint, total bigint")
    got = sorted(map(tuple, quality.cursor_ranges(pages, "cursor", "n", "total", ["list"]).collect()))
    assert got == [
        ("a", "beyond", 20, 22, 1),
        ("a", "doubled", 3, 6, 2),
        ("a", "doubled", 12, 15, 2),
        ("a", "missing", 6, 10, 0),
        ("c", "missing", 0, 2, 0),
        ("c", "missing", 3, 4, 0),
    ]
    one = pages.where("list = 'c'").drop("list")
    assert quality.cursor_ranges(one, "cursor", "n", "total").count() == 2
