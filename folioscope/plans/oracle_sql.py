"""SQL fragments shared by the reference queries; written apart from the Spark code on purpose."""

from folioscope.functions.stopwords import ENGLISH_STOP_WORDS
from folioscope.operators.lemma import IRREGULAR_NOUNS, NOUN_ENDINGS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP_LIST = ", ".join(quoted(w) for w in ENGLISH_STOP_WORDS)

# Splitting at the dollar signs leaves what is outside LaTeX in the odd pieces.
OUTSIDE = """outside AS (
  SELECT doc_id, array_to_string(
    list_filter(string_split(lower(text), '$'), lambda piece, i: i % 2 = 1), ' ') AS body
  FROM documents)"""

WORD_RE = r"\\\p{L}+|[\p{L}\p{N}]+(?:[-''][\p{L}\p{N}]+)*|[^\s\x0b\p{L}\p{N}]"

NUMBER_RE = (
    r"^[+-]?((?i:inf|infinity|nan)|(\p{Nd}(_?\p{Nd})*\.?(\p{Nd}(_?\p{Nd})*)?"
    r"|\.\p{Nd}(_?\p{Nd})*)([eE][+-]?\p{Nd}(_?\p{Nd})*)?)$"
)

TOKENS = f"""{OUTSIDE},
tokens AS (
  SELECT doc_id, list_filter(regexp_extract_all(body, '{WORD_RE}'), lambda w:
    length(w) > 1 AND left(w, 1) <> '\\' AND NOT (left(w, 1) BETWEEN '0' AND '9')
    AND NOT regexp_matches(w, '{NUMBER_RE}') AND w NOT IN ({STOP_LIST})) AS words
  FROM outside)"""

COUNTS = f"""{TOKENS},
surface AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(words) AS term FROM tokens) GROUP BY ALL)"""


def lemmas(terms: str) -> str:
    """CTEs ``forms`` and ``lemmas`` for the distinct terms of CTE ``terms``."""
    forms = ["SELECT term, term AS form, 0 AS pos FROM " + terms]
    for pos, (ending, new) in enumerate(NOUN_ENDINGS, 1):
        forms.append(
            f"SELECT term, left(term, length(term) - {len(ending)}) || '{new}', {pos} "
            f"FROM {terms} WHERE suffix(term, '{ending}')"
        )
    listed = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in IRREGULAR_NOUNS)
    forms.append(
        f"SELECT term, base, -100000 FROM {terms} JOIN (VALUES {listed}) v(plural, base) ON term = plural"
    )
    union = "\n  UNION ALL ".join(forms)
    return f"""forms AS ({union}),
lemmas AS (
  SELECT term, arg_min(form, length(form) * 100 + pos) AS lemma
  FROM forms WHERE form IN (SELECT term FROM {terms}) GROUP BY term)"""


def counted(train: str) -> str:
    """CTE ``counts`` of lemmatised counts; ``train`` says which documents the words come from."""
    return f"""{COUNTS},
terms AS (SELECT DISTINCT term FROM surface WHERE {train}),
{lemmas("terms")},
counts AS (
  SELECT doc_id, coalesce(lemma, term) AS term, sum(tf)::BIGINT AS tf
  FROM surface LEFT JOIN lemmas USING (term) GROUP BY ALL)"""


def weighted(train: str, embedded: str) -> str:
    """CTE ``weights`` of unit vectors for the ``embedded`` documents, fitted on ``train``."""
    return f"""{counted(train)},
model AS (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf_total,
    ln((1 + (SELECT count(*) FROM documents WHERE {train})) / (1.0::DOUBLE + count(*))) + 1 AS idf
  FROM counts WHERE {train} GROUP BY term),
raw AS (
  SELECT doc_id, term, tf * idf AS w FROM counts JOIN model USING (term) WHERE {embedded}),
weights AS (
  SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


# The documents by position: the first nine tenths train, the rest is the test set.
TRAIN = (
    "doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id "
    "LIMIT (SELECT count(*) - floor(count(*) * 0.1)::BIGINT FROM documents))"
)
TEST = f"NOT ({TRAIN})"


def pair_means(members: str) -> str:
    """CTE ``means`` by explicit pairs of the rows of CTE ``members (grp, doc_id)``."""
    return f"""numbered AS (SELECT *, row_number() OVER () AS occ FROM {members}),
pairs AS (
  SELECT a.grp, a.occ AS i, b.occ AS j, sum(x.weight * y.weight) AS cos
  FROM numbered a JOIN numbered b ON a.grp = b.grp AND a.occ < b.occ
  JOIN weights x ON x.doc_id = a.doc_id
  JOIN weights y ON y.doc_id = b.doc_id AND y.term = x.term
  GROUP BY ALL),
means AS (
  SELECT grp, n, avg_cos
  FROM (SELECT grp, count(*) AS n FROM numbered GROUP BY grp)
  LEFT JOIN (SELECT grp, avg(cos) AS avg_cos FROM pairs WHERE cos <> 0 GROUP BY grp) USING (grp))"""
