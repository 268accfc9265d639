"""Fingerprints and components against plain loops over all pairs."""

import random

import pytest
import xxhash

from folioscope.llm import simhash
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables


def plain_fingerprint(text):
    words = []
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(prints)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(len(prints))]


def expected(ids, texts):
    prints = [plain_fingerprint(t) for t in texts]
    return sorted(zip(ids, [f"{p:016x}" for p in prints], plain_components(prints, ids)))


def test_query_on_small_tables(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op9_simhash"](spark, SMALL).collect()
    assert sorted(map(tuple, got)) == expected([r[0] for r in rows], [r[1] for r in rows])


def test_nulls_empty_ties_repeats_and_long_texts(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(70_000))
    texts = [None, "", " \t\n", "one", "One", "one two", "a b c d", "a b c d", "é É x", long, "\x1fa b"]
    ids = [5, 4, 3, 2, 9, 7, 8, 8, 1, 11, 12]
    docs = documents(spark, texts, ids=ids).selectExpr("*", "1 AS fp", "2 AS block", "3 AS root")
    got = QUERIES["op9_simhash"](spark, tables(tmp_path, documents=docs)).collect()
    assert sorted(map(tuple, got)) == expected(ids, texts)


def test_empty_table(spark, tmp_path):
    got = QUERIES["op9_simhash"](spark, tables(tmp_path, documents=documents(spark, [])))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 0


@pytest.mark.parametrize("group_limit", [1, 3, 4096])
def test_links_of_any_group_size(spark, group_limit):
    draw = random.Random(7)
    centres = [draw.getrandbits(64) for _ in range(6)]
    prints = {0}
    for centre in centres:
        for _ in range(25):
            at = centre
            for _ in range(draw.randint(0, 5)):
                at ^= 1 << draw.randrange(64)
            prints.add(at)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = simhash.near_links(distinct, 3, group_limit)
    found = simhash.components(links, "a", "b").collect()
    assert all(
        (r.a ^ r.b).bit_count() <= 3 if (r.a < 0) == (r.b < 0) else (r.a % 2**64 ^ r.b % 2**64).bit_count() <= 3
        for r in links.collect()
    )
    want = plain_components(prints, signed)
    alone = {p for p, c in zip(signed, want) if want.count(c) == 1}
    assert {r.node: r.root for r in found} == {p: c for p, c in zip(signed, want) if p not in alone}


def test_null_ids_do_not_name_a_component(spark):
    docs = documents(spark, ["a b c", "a b c"], ids=[None, 6])
    got = simhash.near_duplicates(docs).collect()
    assert [r.component_id for r in got] == [6, 6]
