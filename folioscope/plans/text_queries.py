"""Queries on document texts: cleaning, tokens, vocabulary, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.functions import text as X
from folioscope.functions.stopwords import ENGLISH_STOP_WORDS
from folioscope.operators import tfidf
from folioscope.operators.lemma import lemma_map
from folioscope.plans import oracle_sql as O
from folioscope.plans.evaluate import embed_all, features, train_and_embed
from folioscope.plans.registry import cores, query, table
from folioscope.sources import sinks
from folioscope.session import scratch_path


def counts_of(spark, sf):
    docs = table(spark, sf, "documents")
    return tfidf.document_counts(docs, "doc_id", "text", partitions=cores(spark))


@query(
    "strip_newlines",
    """
    SELECT doc_id, array_to_string(list_transform(
      string_split(CASE WHEN suffix(text, chr(10)) THEN left(text, length(text) - 1) ELSE text END,
        chr(10)),
      lambda line: trim(line, ' ' || chr(9))), ' ') AS line
    FROM documents
    """,
)
def strip_newlines(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", X.strip_newlines(F.col("text")).alias("line"))


@query(
    "latex_strip",
    f"WITH {O.OUTSIDE} SELECT doc_id, trim(regexp_replace(body, '\\s+', ' ', 'g')) AS body FROM outside",
)
def latex_strip(spark, sf):
    docs = table(spark, sf, "documents")
    body = F.regexp_replace(X.strip_latex(F.lower("text")), r"\s+", " ")
    return docs.select("doc_id", F.trim(body).alias("body"))


@query(
    "tokenize",
    f"""
    WITH {O.TOKENS}
    SELECT doc_id, len(words)::BIGINT AS n_tokens, array_to_string(words, ' ') AS tokens FROM tokens
    """,
)
def tokenize(spark, sf):
    docs = tfidf.spread(table(spark, sf, "documents").select("doc_id", "text"), cores(spark))
    return docs.select("doc_id", X.tokenize(F.col("text")).alias("t")).select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.array_join("t", " ").alias("tokens"),
    )


@query(
    "is_number",
    f"""
    WITH chunks AS (
      SELECT DISTINCT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS token FROM documents)
    SELECT token, regexp_matches(token, '{O.NUMBER_RE}') AS numeric FROM chunks WHERE token <> ''
    """,
)
def is_number(spark, sf):
    docs = table(spark, sf, "documents")
    chunks = docs.select(F.explode(F.split("text", "[ \n]")).alias("token"))
    return (
        chunks.where(F.col("token") != "")
        .distinct()
        .select("token", X.is_number(F.col("token")).alias("numeric"))
    )


@query(
    "stopword_anti",
    f"""
    WITH {O.OUTSIDE},
    words AS (SELECT unnest(regexp_extract_all(body, '{O.WORD_RE}')) AS token FROM outside)
    SELECT token, count(*) AS n FROM words
    WHERE length(token) > 1 AND token NOT IN ({O.STOP_LIST}) GROUP BY token
    """,
)
def stopword_anti(spark, sf):
    docs = tfidf.spread(table(spark, sf, "documents").select("doc_id", "text"), cores(spark))
    tokens = docs.select(
        F.explode(X.words(X.strip_latex(F.lower("text")))).alias("token")
    ).where(F.char_length("token") > 1)
    # a fixed list of 179 words
    stop = spark.createDataFrame([(w,) for w in ENGLISH_STOP_WORDS], "token string")
    kept = tokens.groupBy("token").agg(F.count("*").alias("n"))
    return kept.join(F.broadcast(stop), "token", "left_anti")


@query("term_freq", f"WITH {O.COUNTS} SELECT doc_id, term, tf FROM surface")
def term_freq(spark, sf):
    return tfidf.long_counts(counts_of(spark, sf), "doc_id")


@query(
    "lemma_join",
    f"""
    WITH {O.COUNTS}, terms AS (SELECT DISTINCT term FROM surface), {O.lemmas("terms")}
    SELECT term, lemma FROM lemmas WHERE lemma <> term
    """,
)
def lemma_join(spark, sf):
    terms = tfidf.distinct_terms(counts_of(spark, sf))
    return lemma_map(terms, terms)


@query(
    "idf",
    f"""
    WITH {O.COUNTS}
    SELECT term, count(*) AS df, round(
      ln((1 + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + count(*))) + 1, 6) AS idf
    FROM surface GROUP BY term
    """,
)
def idf(spark, sf):
    model = tfidf.fit(counts_of(spark, sf))
    return model.select("term", "df", F.round("idf", 6).alias("idf"))


@query(
    "vocab_topk",
    f"""
    WITH {O.COUNTS}
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf_total
    FROM surface GROUP BY term ORDER BY tf_total DESC, term LIMIT 500
    """,
)
def vocab_topk(spark, sf):
    return tfidf.fit(counts_of(spark, sf), max_features=500).select("term", "df", "tf_total")


@query(
    "vocab_df_limits",
    f"""
    WITH {O.COUNTS}
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf_total FROM surface GROUP BY term
    HAVING count(*) >= 5 AND count(*) <= 0.4 * (SELECT count(*) FROM documents)
    """,
)
def vocab_df_limits(spark, sf):
    model = tfidf.fit(counts_of(spark, sf), min_df=5, max_df=0.4)
    return model.select("term", "df", "tf_total")


@query(
    "tfidf",
    f"""
    WITH {O.weighted(O.TRAIN, O.TEST)}
    SELECT doc_id, term, round(weight, 6) AS weight FROM weights
    """,
)
def tfidf_weights(spark, sf):
    docs = table(spark, sf, "documents")
    embedded = train_and_embed(docs, "doc_id", "text", ["doc_id"], partitions=cores(spark))
    return tfidf.long_weights(embedded.vectors, "doc_id").select(
        "doc_id", "term", F.round("weight", 6).alias("weight")
    )


@query(
    "tfidf_two_sources",
    f"""
    WITH pair AS (SELECT doc_id * 2 AS doc_id, text FROM documents
      UNION ALL SELECT doc_id * 2 + 1, lang || ' ' || source || ' ' || text FROM documents),
    {O.weighted("true", "true").replace("FROM documents", "FROM pair")}
    SELECT doc_id // 2 AS source_id, CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS source,
      count(*) AS n_terms, round(sum(weight), 6) AS total
    FROM weights GROUP BY ALL
    """,
)
def tfidf_two_sources(spark, sf):
    """Two sources that share all their ids; source and id together are the key."""
    docs = table(spark, sf, "documents")
    prefixed = F.concat_ws(" ", "lang", "source", "text")
    both = docs.select(F.lit("a").alias("source"), "doc_id", "text").unionByName(
        docs.select(F.lit("b").alias("source"), "doc_id", prefixed.alias("text"))
    )
    keyed = both.select(F.struct("source", F.col("doc_id").alias("source_id")).alias("key"), "text")
    embedded = embed_all(keyed, "key", "text", partitions=cores(spark))
    return embedded.vectors.select(
        "key.source",
        "key.source_id",
        F.size("vector").cast("bigint").alias("n_terms"),
        F.round(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x["weight"]), 6).alias("total"),
    )


@query(
    "plugged_tokenizer",
    """
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents)
    GROUP BY ALL
    """,
)
def plugged_tokenizer(spark, sf):
    """Counts by another tokeniser: words are what stands between blanks."""

    def between_blanks(text):
        return F.split(F.lower(text), " ", -1)

    docs = table(spark, sf, "documents")
    counts = tfidf.document_counts(docs, "doc_id", "text", between_blanks, partitions=cores(spark))
    return tfidf.long_counts(counts, "doc_id").withColumn("tf", F.col("tf").cast("bigint"))


@query(
    "model_roundtrip",
    f"""
    WITH {O.counted("true")}
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf_total, round(
      ln((1 + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + count(*))) + 1, 6) AS idf
    FROM counts GROUP BY term
    """,
)
def model_roundtrip(spark, sf):
    docs = table(spark, sf, "documents").withColumn("split", F.lit("train"))
    path = scratch_path(spark, "model")
    sinks.save_model(tfidf.fit(features(docs, "doc_id", "text")), path)
    return sinks.load_model(spark, path).select(
        "term", "df", "tf_total", F.round("idf", 6).alias("idf")
    )


@query(
    "test_set_roundtrip",
    f"""
    WITH {O.weighted(O.TRAIN, O.TEST)}
    SELECT doc_id, source, coalesce(n, 0) AS n_terms, round(coalesce(total, 0), 6) AS total,
      round(coalesce(highest, 0), 6) AS highest
    FROM documents LEFT JOIN (
      SELECT doc_id, count(*) AS n, sum(weight) AS total, max(weight) AS highest
      FROM weights GROUP BY doc_id) USING (doc_id)
    WHERE {O.TEST}
    """,
)
def test_set_roundtrip(spark, sf):
    docs = table(spark, sf, "documents")
    embedded = train_and_embed(docs, "doc_id", "text", ["doc_id"], partitions=cores(spark))
    path = scratch_path(spark, "testset")
    sinks.save_test_set(embedded.documents, embedded.vectors, path)
    docs, vectors = sinks.load_test_set(spark, path)
    weights = F.col("vector.weight")
    sums = vectors.select(
        "doc_id",
        F.size("vector").cast("bigint").alias("n"),
        F.aggregate(weights, F.lit(0.0), lambda t, x: t + x).alias("sum"),
        F.array_max(weights).alias("max"),
    )
    return docs.join(sums, "doc_id", "left").select(
        "doc_id",
        "source",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_terms"),
        F.round(F.coalesce("sum", F.lit(0.0)), 6).alias("total"),
        F.round(F.coalesce("max", F.lit(0.0)), 6).alias("highest"),
    )
