"""The registered queries on the operators of this folder: digests under their contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscope.llm import (
    bpe,
    collocations,
    fingerprint,
    langid,
    licenses,
    mixing,
    pii,
    shards,
    simhash,
    spelling,
    topk,
    toxicity,
    wrapper,
)
from folioscope.plans.registry import query, table
from folioscope.session import stable

WORD_BPE = "word_bpe_49k.json"


def public_vocabulary() -> bpe.Vocabulary:
    """The public word-level vocabulary; its file is read on the driver alone."""
    import public_tokenizers

    return bpe.load_vocabulary(public_tokenizers.path(WORD_BPE))


@query("op10_bpe")
def op10_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, public_vocabulary(), with_ids=False)
    return encoded.selectExpr(
        "doc_id",
        "bpe_n AS n_tokens",
        "bpe_ids_sha256 AS ids_sha256",
        "bpe_decoded_sha256 AS decoded_sha256",
    )


@query("op9_simhash")
def op9_simhash(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        "doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query("op7_toxicity")
def op7_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("tox_segments").alias("n_segments"),
    )


# Weights, seed and quality repeat the constants of mixing.py; the order by key is a plain window.
MIX_SQL = r"""
WITH drawn AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
                + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
           / coalesce(greatest(1 - (length(text) - length(translate(text,
               '$%&#*|_{}<>[]\/=+~^@0123456789', ''))) / greatest(length(text), 1)::DOUBLE,
               0.05::DOUBLE), 0.05::DOUBLE) AS key
    FROM documents
), sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]
               ::DOUBLE AS weight
    FROM drawn GROUP BY source
), levels AS (
    SELECT *, 2.0::DOUBLE * source_size / weight AS need,
           (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
               ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sizes
), targets AS (
    SELECT source, source_size,
           least(2.0::DOUBLE * source_size,
                 (SELECT arg_min(level, need) FROM levels WHERE level <= need) * weight) AS target
    FROM levels
), plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
    FROM targets
), summed AS (
    SELECT d.*, p.source_size, p.target, p.epochs,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) - d.size / 2.0 AS middle
    FROM drawn d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN target - epochs * source_size > 0
                               AND middle <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT
           AS taken
FROM summed
"""


@query("op3_mixing", MIX_SQL)
def op3_mixing(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"), measures_only=True)
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


@query("op1_pii")
def op1_pii(spark, sf):
    found = pii.find_spans(table(spark, sf, "documents").select("doc_id", "text"))
    found = stable(found.select("doc_id", "pii_spans"))
    weights = pii.train(found)
    base = F.filter("pii_spans", lambda s: s["base"])

    def count(kind):
        k = pii.KINDS.index(kind)
        return F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(pii.describe(base), 256).alias("base_sha256"),
        pii.describe(pii.settle(F.col("pii_spans"), weights)).alias("spans"),
    )


@query(
    "op4_topk",
    """
    WITH v AS (
        SELECT vec_id, [floor(64.0::DOUBLE * x::DOUBLE)::BIGINT FOR x IN embedding] AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT a.vec_id AS query_id, b.vec_id,
               coalesce(list_sum([a.q[i] * coalesce(b.q[i], 0) FOR i IN range(1, len(a.q) + 1)]),
                        0)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
        FROM scored
    )
    SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
)
def op4_topk(spark, sf):
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_licenses")
def op6_licenses(spark, sf):
    found = licenses.scan(table(spark, sf, "documents").select("doc_id", "text"))
    names = "n_words n_base first_word last_word base_labels labels score".split()
    return found.select("doc_id", *[F.col(f"lic_{n}").alias(n) for n in names])


@query("op8_fingerprints")
def op8_fingerprints(spark, sf):
    return fingerprint.fingerprints(table(spark, sf, "documents"))


@query("op2_html")
def op2_html(spark, sf):
    found = wrapper.extract(table(spark, sf, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op5_langid")
def op5_langid(spark, sf):
    docs = table(spark, sf, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


# The checksum is folded byte by byte over a table that its rule builds; the generator of the jumps runs
# in 128 bits and is cut to 64.
SHARD_SQL = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
), held AS (
    SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
           xor(list_reduce([4294967295::BIGINT] || [('0x' || h)::BIGINT FOR h IN
                   regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS seed
    FROM documents, crc_table
), jumps AS (
    SELECT DISTINCT seed, seed AS state, 0::BIGINT AS jump FROM held
    UNION ALL
    SELECT seed, next, floor((jump + 1) * (2147483648::DOUBLE
               / ((next // 8589934592)::BIGINT + 1)::DOUBLE))::BIGINT
    FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS next
          FROM jumps WHERE jump <= 8)
), placed AS (
    SELECT seed, max(jump) FILTER (jump < 8)::INT AS shard, max(jump) FILTER (jump < 9)::INT AS grown_shard
    FROM jumps GROUP BY seed
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY
           ('0x' || substr(md5('slot:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32
               || ':' || size), 1, 13))::BIGINT, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       grown_shard
FROM held JOIN placed USING (seed)
"""


@query("op12_sharding", SHARD_SQL)
def op12_sharding(spark, sf):
    placed = shards.number(table(spark, sf, "documents"))
    return placed.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


# Two words are near if deleting the same place makes them equal, or one is the other without a place.
SPELLING_SQL = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
           count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents)
    GROUP BY ALL
), drawn AS (
    SELECT run, n,
           xor(list_reduce([4294967295::BIGINT] || [('0x' || x)::BIGINT FOR x IN
                   regexp_extract_all(hex(encode(id || ':' || run)), '..')],
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM runs, crc_table
), words AS (
    SELECT CASE WHEN h % 31 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word,
           sum(n)::BIGINT AS n
    FROM drawn GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
), cut AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
           row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
    FROM near
), formed AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near,
           CASE WHEN r.other_n >= 10 * w.n THEN r.other END AS form,
           CASE WHEN r.other_n >= 10 * w.n THEN r.other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), ways AS (
    SELECT word, word AS root, 0 AS depth FROM formed
    UNION ALL
    SELECT ways.word, f.form, depth + 1 FROM ways JOIN formed f ON f.word = ways.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(root, depth) AS root FROM ways GROUP BY word) r USING (word)
"""


@query("op13_spelling", SPELLING_SQL)
def op13_spelling(spark, sf):
    return spelling.variants(spelling.vocabulary(table(spark, sf, "documents")))


COLLOCATION_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
    UNION ALL
    SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM words
    UNION ALL
    SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
    FROM words
), counts AS (
    SELECT lang, size, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 10
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2
), cuts AS (
    SELECT c.*, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM candidates c, (SELECT unnest([1, 2]) AS k) WHERE k < size
), scored AS (
    SELECT x.lang, x.size, x.phrase, x.a, x.k, p.f AS l, q.f AS r,
           ((1000000::HUGEINT * x.a * x.a) // (p.f::HUGEINT * q.f))::BIGINT AS score
    FROM cuts x JOIN counts p ON p.lang = x.lang AND p.phrase = x.head AND p.size = x.k
                JOIN counts q ON q.lang = x.lang AND q.phrase = x.tail AND q.size = x.size - x.k
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, inner_phrase, max(a) AS longer_f
    FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS inner_phrase
          FROM candidates WHERE size = 3)
    GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
    FROM lowest s LEFT JOIN longer o ON o.lang = s.lang AND o.inner_phrase = s.phrase
    WHERE 100 * coalesce(longer_f, 0) < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_collocations", COLLOCATION_SQL)
def op11_collocations(spark, sf):
    return collocations.mine(table(spark, sf, "documents"))
