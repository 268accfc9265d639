"""TF-IDF, lemmas, similarity and neighbours against brute force."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioscope.functions import vectors as V
from folioscope.operators import neighbours, tfidf
from folioscope.operators import similarity as sim
from folioscope.operators.lemma import lemma_map
from folioscope.plans import evaluate

WORDS = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(5)]


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of the documents are copies of one text
        text = "waa wab wac" if i % 3 == 0 else " ".join(rng.choices(WORDS, k=rng.randint(0, 8)))
        rows.append((i, text, [f"c{i % 4}", "all"] + (["all"] if i % 10 == 0 else [])))
    return rows


def brute(rows):
    counts = {i: collections.Counter(t.split()) for i, t, _ in rows}
    df = collections.Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(rows)) / (1 + d)) + 1 for t, d in df.items()}
    vectors = {}
    for i, c in counts.items():
        raw = {t: n * idf[t] for t, n in c.items()}
        length = math.sqrt(sum(x * x for x in raw.values()))
        vectors[i] = {t: x / length for t, x in raw.items()} if length else {}
    return vectors


def cosine(a, b):
    return sum(x * b[t] for t, x in a.items() if t in b)


def documents(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string, categories array<string>")


def embedded(spark, rows):
    return evaluate.embed_all(documents(spark, rows), "id", "text", lemmatize=False)


def test_vectors_match_brute_force(spark):
    rows = corpus()
    got = collections.defaultdict(dict)
    for r in tfidf.long_weights(embedded(spark, rows).vectors, "id").collect():
        got[r["id"]][r["term"]] = r["weight"]
    want = brute(rows)
    assert got.keys() == {i for i, v in want.items() if v}
    for i, vector in got.items():
        assert vector == pytest.approx(want[i])
        assert sum(x * x for x in vector.values()) == pytest.approx(1)


@pytest.mark.parametrize("block_terms", [20, sim.BLOCK_TERMS])
def test_mean_similarity_matches_all_pairs(spark, block_terms):
    rows = corpus()
    done = embedded(spark, rows)
    members = sim.occurrences(done.documents, "id", "categories")
    got = {
        r["category"]: (r["n"], r["avg_cos"])
        for r in sim.mean_similarity(members, done.vectors, "id", ["category"], block_terms).collect()
    }
    vectors = brute(rows)
    groups = collections.defaultdict(list)
    for i, _, categories in rows:
        for c in categories:
            groups[c].append(vectors[i])
    assert got.keys() == groups.keys()
    for c, listed in groups.items():
        pairs = [cosine(a, b) for k, a in enumerate(listed) for b in listed[:k]]
        held = [x for x in pairs if x]
        assert got[c][0] == len(listed)
        assert got[c][1] == pytest.approx(sum(held) / len(held))


CASES = [
    (1, "waa", ["single"]),
    (2, "wab", ["apart"]),
    (3, "wac", ["apart"]),
    (4, "wad wae", ["equal"]),
    (5, "wad wae", ["equal"]),
    (6, "waf", ["twice", "twice"]),
    (7, "wag", ["withzero"]),
    (8, "wag", ["withzero"]),
    (9, "", ["withzero", "empty"]),
]


def test_similarity_cases(spark):
    done = embedded(spark, CASES)
    members = sim.occurrences(done.documents, "id", "categories")
    result = sim.mean_similarity(members, done.vectors, "id", ["category"])
    got = {r["category"]: (r["n"], r["avg_cos"]) for r in result.collect()}
    assert got["single"] == (1, None) and got["apart"] == (2, None) and got["empty"] == (1, None)
    assert got["equal"] == (2, pytest.approx(1)) and got["twice"] == (2, pytest.approx(1))
    assert got["withzero"] == (3, pytest.approx(1))


def test_dense_mean_similarity(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, [float(x) for x in rng.normal(size=4)]) for i in range(40)]
    rows += [(100, 0, [0.0] * 4), (101, 1, [1.0, 0.0, 0.0, 0.0]), (102, 1, [0.0, 1.0, 0.0, 0.0]), (103, 9, [1.0] * 4)]
    # these count as members and form no pair
    unfit = [(110, 0, None), (111, 0, [1.0] * 3), (112, 0, [1.0, None, 0.0, 0.0]), (113, 7, None)]
    table = spark.createDataFrame(rows + unfit, "id bigint, label int, v array<float>")
    result = sim.dense_mean_similarity(table, "id", "v", ["label"], block_vectors=5, dims=4)
    for r in result.collect():
        if r["label"] == 7:
            assert r["n"] == 1 and r["avg_cos"] is None
            continue
        more = sum(label == r["label"] for _, label, _ in unfit)
        m = np.array([v for _, label, v in rows if label == r["label"]], dtype=np.float32).astype(float)
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        unit = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
        low = np.tril(unit @ unit.T, -1)
        n = np.count_nonzero(low)
        assert r["n"] == len(m) + more
        assert r["avg_cos"] == (pytest.approx(low.sum() / n) if n else None)


@pytest.mark.parametrize("heavy", [0, 3, neighbours.HEAVY_TERMS])
def test_sparse_neighbours_match_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(neighbours, "BLOCK_TERMS", 40)
    monkeypatch.setattr(neighbours, "HEAVY_TERMS", heavy)
    monkeypatch.setattr(neighbours, "QUERY_CHUNK", 4)
    rows = corpus()
    vectors = brute(rows)
    got = collections.defaultdict(list)
    for r in (
        neighbours.similar_sparse(*[embedded(spark, rows).vectors] * 2, "id", k=4)
        .orderBy("id", "rank")
        .collect()
    ):
        got[r["id"]].append((r["other"], r["cos"]))
    for i, vector in vectors.items():
        scores = [(round(cosine(vector, w), 9), j) for j, w in vectors.items() if j != i]
        if not vector:
            continue
        want = sorted([(-s, j) for s, j in scores if vectors[j]])[:4]
        assert got.get(i, []) == [(j, pytest.approx(-s, abs=1e-8)) for s, j in want]


def test_dense_neighbours_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 7)
    rng = np.random.default_rng(6)
    m = rng.normal(size=(30, 5))
    unfit = [(90, None), (91, [1.0]), (92, [None] * 5)]
    table = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(m)] + unfit, "id bigint, v array<double>"
    )
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    products = np.round(unit @ unit.T, 9)
    got = neighbours.similar_dense(table, table, "id", "v", k=28, dims=5).orderBy("id", "rank").collect()
    want = []
    for i in range(30):
        order = sorted((-products[i, j], j) for j in range(30) if j != i)[:28]
        want += [(i, k, j, pytest.approx(-s)) for k, (s, j) in enumerate(order, 1)]
    assert [tuple(r) for r in got] == want


def test_neighbours_of_opposed_vectors_are_ranked(spark):
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = neighbours.similar_dense(table, table, "id", "v", k=2, dims=2).orderBy("id", "rank")
    assert [(r["id"], r["other"], r["cos"]) for r in got.collect()][:2] == [(1, 3, 0.0), (1, 2, -1.0)]
    least = neighbours.similar_dense(table, table, "id", "v", k=2, dims=2, min_score=-0.5)
    assert least.count() == 4


@pytest.mark.parametrize("leaders, floor", [(1, None), (3, None), (8, 0.2), (40, None)])
def test_sparse_search_with_other_queries(spark, leaders, floor):
    """Topics of their own, so that some leaders are left out; queries that are no documents."""
    rng = random.Random(leaders)
    topics = [[f"t{chr(97 + t)}{chr(97 + i)}x" for i in range(12)] for t in range(5)]
    rows = [(i, " ".join(rng.choices(topics[i % 5], k=6)), []) for i in range(80)]
    done = embedded(spark, rows)
    vectors = brute(rows)
    asked = done.vectors.where("id < 15").select((F.col("id") + 1000).alias("id"), "vector")
    found = neighbours.similar_sparse(
        asked, done.vectors, "id", k=3, min_score=floor, leaders=leaders, block_terms=30
    ).collect()
    got = {(r["id"], r["rank"]): (r["other"], r["cos"]) for r in found}
    for q in range(15):
        scores = [(-round(cosine(vectors[q], w), 12), j) for j, w in vectors.items()]
        want = [(j, -s) for s, j in sorted(scores)[:3] if floor is None or -s >= floor]
        for rank, (j, s) in enumerate(want, 1):
            assert got.pop((q + 1000, rank)) == (j, pytest.approx(s, abs=1e-8))
    assert not got


def test_bounds_leave_blocks_out(spark, monkeypatch):
    """Five topics without a word in common: a query sees the documents of its own topic only."""
    rng = random.Random(2)
    topics = [[f"t{chr(97 + t)}{chr(97 + i)}x" for i in range(12)] for t in range(5)]
    rows = [(i, " ".join(rng.choices(topics[i % 5], k=8)), []) for i in range(100)]
    visits, blocks = [], []
    partial = neighbours._partial_top_k

    def watched(queries, corpus, *args):
        visits.append((corpus if queries is None else queries).count())
        blocks.append(corpus.select("block").distinct().count())
        return partial(queries, corpus, *args)

    monkeypatch.setattr(neighbours, "_partial_top_k", watched)
    vectors = embedded(spark, rows).vectors
    neighbours.similar_sparse(vectors, vectors, "id", k=2, leaders=20, block_terms=30).collect()
    home, further = visits
    assert home == 100 and blocks[0] > 10 and further < 100 * (blocks[0] - 1) / 2


def test_copies_for_visits_are_made_by_many_tasks(spark, monkeypatch):
    """What one task emits stays a small part of all rows that are sent to blocks."""
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 30)
    sent, scored = [], neighbours._scored

    def watched(both, *args):
        sent.append(sorted(r["count"] for r in both.groupBy(F.spark_partition_id()).count().collect()))
        return scored(both, *args)

    monkeypatch.setattr(neighbours, "_scored", watched)
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 5)))]
    table = spark.createDataFrame(rows, "id bigint, v array<double>")
    neighbours.similar_dense(table, table, "id", "v", k=20, dims=5).collect()
    _, further = sent
    assert sum(further) > 3_000 and max(further) < sum(further) / 12


def test_empty_sides_of_a_search(spark):
    vectors = embedded(spark, corpus()).vectors
    none = vectors.where("id < 0")
    assert neighbours.similar_sparse(none, vectors, "id").count() == 0
    assert neighbours.similar_sparse(vectors, none, "id").count() == 0
    dense = spark.createDataFrame([(1, [1.0, 0.0])], "id bigint, v array<double>")
    assert neighbours.similar_dense(dense.where("id < 0"), dense, "id", "v", dims=2).count() == 0
    assert neighbours.similar_dense(dense, dense.where("id < 0"), "id", "v", dims=2).count() == 0


def test_disjoint_masks_are_counted(spark):
    rng = np.random.default_rng(4)
    masks, counts = np.arange(32), rng.integers(0, 5, 32)
    listed = np.repeat(masks, counts)
    want = sum(a & b == 0 for i, a in enumerate(listed) for b in listed[:i])
    assert sim.disjoint_pairs(masks, counts, 5) == want
    many = counts * 10**10
    n0 = int(many[0])
    ordered = sum(int(a) * int(b) for i, a in enumerate(many) for j, b in enumerate(many) if i & j == 0)
    assert sim.disjoint_pairs(masks, many, 5) == (ordered - n0) // 2


@pytest.mark.parametrize("frequent", [1, 4, 16])
def test_pairs_of_classes_match_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(sim, "FREQUENT", frequent)
    rng = random.Random(frequent)
    rows = [(i, " ".join(rng.sample(WORDS, rng.randint(0, 3))), [f"c{i % 2}"]) for i in range(120)]
    done = embedded(spark, rows)
    members = sim.occurrences(done.documents, "id", "categories")
    tagged = sim.tag(members, done.vectors, "id", ["category"])
    sets = {i: set(t.split()) for i, t, _ in rows}
    want = {
        f"c{c}": sum(bool(sets[i] & sets[j]) for i in sets for j in sets if i < j and i % 2 == j % 2 == c)
        for c in (0, 1)
    }
    for block_terms in (5, 10_000):
        got = sim.nonzero_pairs(tagged, ["category"], block_terms).collect()
        assert {r["category"]: r["nonzero_pairs"] for r in got} == want


@pytest.mark.parametrize("hot_terms", [0, 3, 1000])
def test_hot_terms_are_joined_apart(spark, monkeypatch, hot_terms):
    rows = corpus()
    counts = tfidf.document_counts(documents(spark, rows), "id", "text")
    model = tfidf.fit(counts)
    small = sorted(map(str, tfidf.transform(counts, "id", model).collect()))
    monkeypatch.setattr("folioscope.session.BROADCAST_ROWS", 2)
    assert sorted(map(str, tfidf.transform(counts, "id", model, hot_terms).collect())) == small


def test_cosine_of_zero_vector_is_zero(spark):
    row = spark.sql("select array(0d, 0d) a, array(1d, 2d) b, array(2d, 4d) c").select(
        V.cosine(F.col("a"), F.col("b")), V.cosine(F.col("b"), F.col("c")), V.has_dims(F.col("a"), 2)
    )
    assert tuple(row.first()) == (0.0, pytest.approx(1), True)


def test_lemmas_are_the_shortest_known_form(spark):
    def frame(words):
        return spark.createDataFrame([(w,) for w in words], "term string")

    terms = ["cats", "cat", "bus", "wolves", "wolf", "boxes", "box", "women", "woman", "studies", "study", "ashes"]
    known = {r["term"]: r["lemma"] for r in lemma_map(frame(terms), frame(terms)).collect()}
    assert known == {"cats": "cat", "wolves": "wolf", "boxes": "box", "studies": "study"}
    # "women" gives way only to a lexicon that does not list it
    other = lemma_map(frame(terms), frame(["woman", "ash", "cat"])).collect()
    assert {r["term"]: r["lemma"] for r in other} == {"women": "woman", "ashes": "ash", "cats": "cat"}


def test_irregular_nouns_go_before_the_rules(spark):
    def frame(words):
        return spark.createDataFrame([(w,) for w in words], "term string")

    terms = ["children", "child", "indices", "index", "matrices", "axes", "axis", "axe", "mice", "criteria"]
    known = {r["term"]: r["lemma"] for r in lemma_map(frame(terms), frame(terms)).collect()}
    # a base form that the lexicon does not list is no lemma
    assert known == {"children": "child", "indices": "index", "axes": "axis"}


def test_lemmatised_counts_add_up(spark):
    rows = [(1, "cats cat cats dog", []), (2, "", []), (3, "dogs dog", []), (4, "bird", [])]
    counts = tfidf.document_counts(documents(spark, rows), "id", "text")
    merged = tfidf.lemmatize_counts(counts, "id", tfidf.training_lemmas(counts))
    got = {r["id"]: [(x["term"], x["tf"]) for x in r["counts"]] for r in merged.collect()}
    assert got == {1: [("cat", 3), ("dog", 1)], 2: [], 3: [("dog", 2)], 4: [("bird", 1)]}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lemmas_and_frequent_terms_move_no_words(spark):
    """Few lemmas are looked up in tasks, and terms sent to the tasks are neither joined nor shuffled."""
    rows = [(1, "cats cat cats dog", []), (2, "", []), (3, "dogs dog", []), (None, "cats", [])]
    counts = tfidf.document_counts(documents(spark, rows), "id", "text")
    merged = tfidf.lemmatize_counts(counts, "id", tfidf.training_lemmas(counts))
    assert "Exchange" not in plan_of(merged) and "Join" not in plan_of(merged)
    got = {r["id"]: [tuple(x) for x in r["counts"]] for r in merged.collect()}
    assert got == {1: [("cat", 3), ("dog", 1)], 2: [], 3: [("dog", 2)], None: [("cats", 1)]}
    vectors = tfidf.transform(merged, "id", tfidf.fit(merged))
    assert "Join" not in plan_of(vectors)
    assert {r["id"]: [x["term"] for x in r["vector"]] for r in vectors.collect()} == {
        1: ["cat", "dog"], 3: ["dog"], None: ["cats"],
    }


def test_many_lemmas_are_joined(spark, monkeypatch):
    rows = [(1, "cats cat cats dog", []), (2, "", []), (3, "dogs dog", []), (4, "bird", [])]
    counts = tfidf.document_counts(documents(spark, rows), "id", "text")
    lemmas = tfidf.training_lemmas(counts)
    few = sorted(map(str, tfidf.lemmatize_counts(counts, "id", lemmas).collect()))
    monkeypatch.setattr(tfidf, "TASK_LEMMAS", 0)
    many = tfidf.lemmatize_counts(counts, "id", lemmas)
    assert "Join" in plan_of(many) and sorted(map(str, many.collect())) == few


def test_vocabulary_limits(spark):
    rows = [(1, "aa bb cc", []), (2, "aa bb", []), (3, "aa dd dd dd", []), (4, "", [])]
    counts = tfidf.document_counts(documents(spark, rows), "id", "text")

    def terms(**limits):
        return sorted(r["term"] for r in tfidf.fit(counts, **limits).collect())

    assert terms() == ["aa", "bb", "cc", "dd"]
    assert terms(min_df=2) == ["aa", "bb"] and terms(min_df="0.5") == ["aa", "bb"]
    assert terms(max_df=0.5) == ["bb", "cc", "dd"] and terms(max_df=1) == ["cc", "dd"]
    assert terms(max_features=2) == ["aa", "dd"] and terms(min_df=2, max_features=1) == ["aa"]
    with pytest.raises(ValueError):
        tfidf.df_limit("1.5")
    assert tfidf.df_limit(0) is None and tfidf.df_limit("3") == 3


def test_unknown_terms_are_ignored_before_the_norm(spark):
    train = tfidf.document_counts(documents(spark, [(1, "aa bb", []), (2, "aa", [])]), "id", "text")
    test = tfidf.document_counts(documents(spark, [(7, "aa zz", []), (8, "zz", [])]), "id", "text")
    vectors = tfidf.transform(test, "id", tfidf.fit(train)).collect()
    assert [(r["id"], [tuple(x) for x in r["vector"]]) for r in vectors] == [(7, [("aa", 1.0)])]


def test_report_with_a_category_called_random(spark, tmp_path):
    from folioscope.sources import sinks

    rows = [(i, "waa wab", ["random"]) for i in range(4)] + [(9, "wac", ["lone"])]
    report = evaluate.similarity_report(embedded(spark, rows), "id", "categories", num_random=1000)
    sinks.write_report(report, str(tmp_path / "r"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert sorted(lines) == [" nan\t1\tlone", "1.000000\t4\trandom", "1.000000\t5\trandom"]


def test_packed_blocks_and_parts_of_bit_sets_match_all_pairs(monkeypatch):
    """Blocks read back from bytes, compared within themselves and with each other, a few rows at a time."""
    monkeypatch.setattr(sim, "BIT_ROWS", 7)
    monkeypatch.setattr(sim, "BIT_TERMS", 20)
    rng = random.Random(7)
    words = [f"é{i}" for i in range(40)]
    rows = [
        {"copies": rng.choice([1, 1, 3]), "mask": rng.choice([0, 0, 1, 6]), "terms": rng.sample(words, rng.randint(1, 3))}
        for _ in range(60)
    ]

    def packed(part):
        table = pa.table({c: [r[c] for r in part] for c in ("copies", "mask", "terms")})
        block = sim._block(table)
        names = [field.split()[0] for field in sim.PACKED.split(", ")]
        return dict(zip(names, sim._packed(block, np.ones(len(part), dtype=bool))))

    def meet(a, b):
        return not a["mask"] & b["mask"] and bool({*a["terms"]} & {*b["terms"]})

    left, right = rows[:35], rows[35:]
    blocks = [{**packed(part), "lo": 0, "hi": 1} for part in (left, right)]
    want = sum(a["copies"] * b["copies"] for a in left for b in right if meet(a, b))
    assert sim._packed_pairs(pa.Table.from_pylist(blocks)) == want > 0
    assert sim._packed_pairs(pa.Table.from_pylist(blocks[:1])) == 0
    want = sum(a["copies"] * b["copies"] for i, a in enumerate(rows) for b in rows[:i] if meet(a, b))
    want += sum(r["copies"] * (r["copies"] - 1) // 2 for r in rows if not r["mask"])
    assert sim._packed_pairs(pa.Table.from_pylist([{**packed(rows), "lo": 2, "hi": 2}])) == want


def test_blocks_are_sent_once_per_pair_not_row_by_row(spark, monkeypatch):
    """A block goes to the others in one row; before, each of its rows went to each of them."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.sample(WORDS, 3)), ["c"]) for i in range(120)]
    done = embedded(spark, rows)
    members = sim.occurrences(done.documents, "id", "categories")
    tagged = sim.tag(members, done.vectors, "id", ["category"])
    sent, class_blocks = [], sim._class_blocks

    def watched(*args):
        blocks = class_blocks(*args)
        counted = blocks.groupBy("lo", "hi").count().collect()
        sent.append((len({r["hi"] for r in counted}), max(r["count"] for r in counted)))
        return blocks

    monkeypatch.setattr(sim, "_class_blocks", watched)
    sim.nonzero_pairs(tagged, ["category"], 40).collect()
    (n_blocks, most), = sent
    assert n_blocks > 3 and most <= 2


@pytest.mark.parametrize("by", [["kind", "category"], ["own", "other"], ["mask", "terms"], ["_by1", "n_terms"]])
def test_group_columns_of_any_name_in_large_categories(spark, by):
    """A report groups by kind and category; ``kind`` was the name of a column of blocks, too."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.sample(WORDS, 3)), []) for i in range(60)]
    done = embedded(spark, rows)
    members = done.documents.select(
        (F.col("id") % 2).alias(by[0]), F.lit("c").alias(by[1]), "id"
    )
    result = sim.mean_similarity(members, done.vectors, "id", by, block_terms=20).collect()
    vectors = brute(rows)
    for r in result:
        scores = [cosine(vectors[i], vectors[j]) for i in vectors for j in vectors if i < j and i % 2 == j % 2 == r[0]]
        assert r[1] == "c" and r["n"] == 30
        assert r["avg_cos"] == pytest.approx(sum(scores) / sum(s > 0 for s in scores))
    assert len(result) == 2


def test_sparse_search_shuffles_no_copy_of_a_block(spark, monkeypatch):
    """Blocks meet in a Cartesian product of packed values; before, each visit copied rows into a shuffle."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(WORDS, k=6)), []) for i in range(120)]
    vectors = embedded(spark, rows).vectors
    met, elsewhere = [], neighbours._found_elsewhere

    def watched(asked, held, *args):
        found = elsewhere(asked, held, *args)
        met.append((held.count(), asked.count(), plan_of(found)))
        return found

    monkeypatch.setattr(neighbours, "_found_elsewhere", watched)
    got = neighbours.similar_sparse(vectors, vectors, "id", k=3, block_terms=40).count()
    (held, asked, plan), = met
    assert got == 3 * vectors.count() and held == asked > 5
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_rows_below_the_bar_are_neither_scored_nor_sent():
    """Two blocks without a common word, and one that holds nothing better than the bar."""

    def block(*rows):
        pairs = [[{"term": t, "weight": w} for t, w in r] for r in rows]
        return neighbours._rows(pa.table({"id": list(range(len(rows))), "vector": pairs}), "id")

    asked = neighbours._unpacked_rows(pa.py_buffer(neighbours._packed_rows(block([("a", 0.6), ("b", 0.8)]))))
    for held, bar, want in [
        (block([("c", 1.0)]), 0.1, []),
        (block([("c", 1.0)]), -np.inf, [0.0]),
        (block([("a", 1.0)], [("b", 1.0)]), 0.7, [0.8]),
        (block([("a", 1.0)], [("b", 1.0)]), 0.8, [0.8]),
        (block([("a", 1.0)], [("b", 1.0)]), 0.9, []),
    ]:
        held = held._replace(keys=pa.array(range(10, 10 + len(held.keys))))
        found, _ = neighbours._visit(asked, held, 2, np.array([bar]))
        assert found["cos"].to_pylist() == want


def test_categories_shuffle_neither_vectors_nor_pairs(spark, monkeypatch):
    """Vectors meet their categories where they are gathered, and blocks meet without a shuffle."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(WORDS, k=4)), [f"c{i % 2}", "all"]) for i in range(90)]
    done = embedded(spark, rows)
    members = sim.occurrences(done.documents, "id", "categories")
    plain = sim.mean_similarity(members, done.vectors, "id", ["category"], 40).collect()
    plans, gathered, class_blocks = [], [], sim._class_blocks

    def watched(*args):
        blocks = class_blocks(*args)
        plans.append(plan_of(blocks))
        return blocks

    def beside(*args):
        found = done.vectors_beside(*args)
        gathered.append(plan_of(found))
        return found

    monkeypatch.setattr(sim, "_class_blocks", watched)
    monkeypatch.setattr(sim, "PART_TERMS", 50)
    monkeypatch.setattr(sim, "PIECE_WORDS", 4)
    again = sim.mean_similarity(members, beside, "id", ["category"], 40).collect()
    assert sorted((r[0], r[1], round(r[2], 12)) for r in again) == sorted((r[0], r[1], round(r[2], 12)) for r in plain)
    assert "CartesianProduct" in plans[0] and "Exchange" not in plans[0]
    # below the join of gathered counts and groups there is one exchange of each side, and none above it
    assert "Exchange" not in gathered[0].split("Join")[0]


def test_totals_of_terms_do_not_depend_on_parts(spark, monkeypatch):
    """Repeated documents, a term twice in a vector, categories of null."""
    def vector(*terms):
        return [(t, 0.25 + 0.125 * i) for i, t in enumerate(terms)]

    rows = [([("a",)], vector("x", "y")), ([("a",), ("b",)], vector("x", "y")), ([("a",)], vector("z", "z"))]
    rows += [([("b",), (None,)], vector("é", "x")), ([("b",), ("b",)], vector("w"))]
    rows += [([("once",)], vector("v", "v"))]
    tagged = spark.createDataFrame(rows * 2 + [([("lone",)], vector("u", "u"))], "groups array<struct<c:string>>, vector array<struct<term:string,weight:double>>")
    wanted = {"lone": [vector("u", "u")]}
    for groups, v in rows * 2:
        for (c,) in groups:
            wanted.setdefault(c, []).append(v)
    for size in (1, sim.PART_TERMS):
        monkeypatch.setattr(sim, "PART_TERMS", size)
        _, totals, names = sim._summed_up(tagged, ["c"], tagged.coalesce(1).mapInArrow)
        got = {r[0]: r[1] for r in totals.groupBy(*names).agg(F.sum("pair_sum")).collect()}
        pairs = {r[0]: r[1] for r in sim.nonzero_pairs(tagged, ["c"], 2).collect()}
        for c, held in wanted.items():
            if c is None:
                continue
            sums, squares = collections.Counter(), collections.Counter()
            for v in held:
                for t, w in v:
                    sums[t] += w
                    squares[t] += w * w
            assert got[c] == pytest.approx(sum(sums[t] ** 2 - squares[t] for t in sums) / 2)
            assert pairs[c] == sum(
                bool({t for t, _ in a} & {t for t, _ in b}) for i, a in enumerate(held) for b in held[:i]
            )
