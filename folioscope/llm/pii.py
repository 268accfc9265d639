r"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from the four base patterns and from two looser ones (telephone numbers without
a country code, addresses whose at-sign is spelled out). Three labelers vote on each candidate: a
strict pattern check, a gazetteer (top-level domains, country codes, card issuers, reserved
networks), and the words right before it. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is for each kind; the posteriors then train a logistic span
classifier on the votes and on whether the span stands alone. Base spans always stay; a further
candidate is added if the classifier gives it at least ``ADD_FROM``.

Only the counts of vote patterns reach the driver, at most ``4 * 27 * 2`` rows whatever the input.
Positions are found with ``split``: the lengths of the pieces between the matches, added up.

Defined results: a null or empty text has no spans; repeated rows are rows of their own; an empty
table gives no rows; columns with clashing names are untouched, the added one is ``pii_spans``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import let

KINDS = ("email", "ip", "card", "phone")
ADD_FROM = 0.5
CONTEXT = 40
EM_ROUNDS = 50

# Possessive repeats keep the matcher iterative; \G lets a match begin where the last one ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    # only runs of 14 digits and more can pass, so shorter ones are not taken up
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?"
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}){1,8}",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9.-])",
}
LUHN_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

TOP_LEVELS = (
    "com org net edu gov mil int info biz io co de fr es uk us eu it nl be ch at pl pt ru cn jp in br au "
    "ca mx ar se no fi dk cz gr ie nz za kr tr ua"
).split()
COUNTRY_CODES = "1|7|20|27|3[0123469]|4[013456789]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|4[2][0-9]|5[09][0-9]|6[789][0-9]|8[05789][0-9]|9[679][0-9]"
CARD_ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6(?:011|5|4[4-9])|3(?:0[0-5]|[689])|35"
RESERVED_NETWORKS = r"0\.|127\.|22[4-9]\.|2[34][0-9]\.|25[0-5]\."
FOR_WORDS = {
    "email": r"e-?mail|mailto|contact|write|reach|courriel|correo|kontakt",
    "ip": r"\bips?\b|host|server|address|client|network|login",
    "card": r"card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|fax|mobile|cell|contact|anruf|appel|llam",
}
AGAINST_WORDS = {
    "email": r"commit|clone|git\b",
    "ip": r"version|release|section|\bv\.?\s*$",
    "card": r"isbn|serial|tracking|order|invoice|\bids?\b|token",
    "phone": r"isbn|serial|tracking|order|invoice|\bids?\b|version",
}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    doubled = F.array(*map(F.lit, LUHN_DOUBLED))
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    parts = F.transform(
        numbers, lambda d, i: F.when(i % 2 == 1, F.get(doubled, d)).otherwise(d)
    )
    return F.aggregate(parts, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _strict(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.split(F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", ""), r"\.")
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(14, 19) & luhn(digits)
    return F.length(_digits(value)).between(10, 15)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    if no is not None:
        return vote.when(no, -1).otherwise(0)
    return vote.otherwise(-1)


def _known(kind: str, value: Column) -> Column:
    """The gazetteer's vote."""
    if kind == "email":
        last = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1))
        return _vote(last.isin(*TOP_LEVELS), last.rlike("^[0-9]+$"))
    if kind == "ip":
        return _vote(~value.rlike(f"^(?:{RESERVED_NETWORKS})"))
    if kind == "card":
        return _vote(_digits(value).rlike(f"^(?:{CARD_ISSUERS})"))
    return _vote(value.rlike(rf"^\+(?:{COUNTRY_CODES})"), value.startswith("+"))


def _found(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Matches of one pattern as an array of spans with votes."""

    def spans(parts: Column) -> Column:
        pieces, values = parts["pieces"], parts["values"]
        # running ends: after piece 0, match 0, piece 1, match 1, ...
        lengths = F.zip_with(
            F.slice(pieces, 1, F.size(values)), values, lambda p, v: F.struct(
                F.length(p).alias("gap"), F.length(v).alias("size")
            )
        )
        starts = F.aggregate(
            lengths,
            F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts")),
            lambda a, x: F.struct(
                (a["end"] + x["gap"] + x["size"]).alias("end"),
                F.concat(a["starts"], F.array(a["end"] + x["gap"])).alias("starts"),
            ),
        )["starts"]

        def span(value: Column, i: Column) -> Column:
            before = F.lower(F.substring(F.get(pieces, i), -CONTEXT, CONTEXT))
            after = F.substring(F.get(pieces, i + 1), 1, 1)
            start = F.get(starts, i)
            strict = _strict(kind, value)
            alone = ~F.substring(before, -1, 1).rlike(r"[\p{L}\p{N}]") & ~after.rlike(r"[\p{L}\p{N}]")
            return F.struct(
                start.cast("long").alias("start"),
                F.lit(KINDS.index(kind)).alias("kind"),
                (start + F.length(value)).cast("long").alias("end"),
                (F.lit(base) & strict).alias("base"),
                _vote(strict & F.lit(base), F.lit(base)).alias("v1"),
                _known(kind, value).alias("v2"),
                _vote(
                    before.rlike(FOR_WORDS[kind]), before.rlike(AGAINST_WORDS[kind])
                ).alias("v3"),
                alone.alias("alone"),
            )

        return F.transform(values, span)

    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # texts without a match, nearly all, are not cut
    return let(
        values,
        lambda v: F.when(
            F.size(v) > 0,
            let(F.struct(F.split(text, pattern, -1).alias("pieces"), v.alias("values")), spans),
        ),
    )


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by start, then kind."""
    found = [_found(text, kind, BASE[kind], True) for kind in KINDS]
    found += [_found(text, kind, pattern, False) for kind, pattern in LOOSE.items()]
    return F.array_sort(F.flatten(F.array(*[F.coalesce(f, F.array().cast(_SPAN)) for f in found])))


_SPAN = (
    "array<struct<start:bigint,kind:int,end:bigint,base:boolean,v1:int,v2:int,v3:int,alone:boolean>>"
)


def vote_patterns(spans: DataFrame) -> list[tuple]:
    """``(kind, v1, v2, v3, alone, count)``, at most 216 rows."""
    rows = (
        spans.select(F.explode("pii_spans").alias("s"))
        .groupBy("s.kind", "s.v1", "s.v2", "s.v3", "s.alone")
        .count()
        .collect()
    )
    return [tuple(r) for r in rows]


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def posterior(pattern: tuple, prior: float, table: dict) -> float:
    """Chance that a candidate with these votes is personal data; an abstention says nothing."""
    odds = math.log(prior / (1 - prior))
    for labeler, vote in enumerate(pattern[1:4]):
        if vote:
            odds += math.log(table[labeler, True, vote] / table[labeler, False, vote])
    return _sigmoid(odds)


def reliabilities(patterns: list[tuple]) -> tuple[dict, dict]:
    """Per kind the share of true spans and ``{(labeler, truth, vote): probability}``, by EM.

    Votes are independent given the truth; counts are smoothed towards labelers that are better than
    chance. Starts from the sum of the votes.
    """
    priors, tables = {}, {}
    for kind in sorted({p[0] for p in patterns}):
        own = [p for p in patterns if p[0] == kind]
        post = {p: _sigmoid(2.0 * p[1] + p[2] + p[3]) for p in own}
        for _ in range(EM_ROUNDS):
            true = sum(post[p] * p[5] for p in own)
            priors[kind] = (true + 1) / (sum(p[5] for p in own) + 2)
            table = {}
            for labeler in range(3):
                for truth in (True, False):
                    right = 1 if truth else -1
                    mass = {right: 2.0, -right: 1.0}
                    for p in own:
                        if vote := p[1 + labeler]:
                            mass[vote] += p[5] * (post[p] if truth else 1 - post[p])
                    table |= {(labeler, truth, v): m / sum(mass.values()) for v, m in mass.items()}
            tables[kind] = table
            post = {p: posterior(p, priors[kind], table) for p in own}
    return priors, tables


def _features(kind: int, v1: int, v2: int, v3: int, alone: bool) -> list[tuple]:
    return [("kind", kind), ("v1", kind, v1), ("v2", kind, v2), ("v3", kind, v3), ("alone", bool(alone))]


def train(spans: DataFrame, rounds: int = 400) -> dict:
    """Weights of the span classifier: logistic regression on the posteriors of all candidates."""
    patterns = vote_patterns(spans)
    if not patterns:
        return {}
    priors, tables = reliabilities(patterns)
    wanted = {p: posterior(p, priors[p[0]], tables[p[0]]) for p in patterns}
    weights: dict = {}
    total = sum(p[5] for p in patterns)
    for _ in range(rounds):
        gradient: dict = {}
        for p in patterns:
            names = _features(*p[:5])
            z = sum(weights.get(n, 0.0) for n in names)
            error = (_sigmoid(z) - wanted[p]) * p[5] / total
            for n in names:
                gradient[n] = gradient.get(n, 0.0) + error
        for n, g in gradient.items():
            weights[n] = weights.get(n, 0.0) - 2.0 * (g + 1e-5 * weights.get(n, 0.0))
    return weights


def _accepted(span: Column, weights: dict) -> Column:
    """The classifier as a column: the weights of the span's features, added up."""

    def weight_of(name: str, value: Column) -> Column:
        table = {n[1:]: w for n, w in weights.items() if n[0] == name}
        picked = F.lit(0.0)
        for key, w in table.items():
            if name in ("kind", "alone"):
                hit = value == F.lit(key[0])
            else:
                hit = (span["kind"] == key[0]) & (value == key[1])
            picked = picked + F.when(hit, F.lit(w)).otherwise(0.0)
        return picked

    z = sum(
        (weight_of(n, span[n]) for n in ("v1", "v2", "v3", "alone")), weight_of("kind", span["kind"])
    )
    return 1 / (1 + F.exp(-z)) >= ADD_FROM


def settle(spans: Column, weights: dict) -> Column:
    """Base spans, and accepted further ones that overlap no base span of their kind."""
    base = F.filter(spans, lambda s: s["base"])
    further = F.filter(
        spans,
        lambda s: ~s["base"]
        & _accepted(s, weights)
        & ~F.exists(
            base,
            lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"]),
        ),
    )
    return F.when(F.size(spans) > 0, F.array_sort(F.concat(base, further))).otherwise(spans)


def describe(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``, all candidates; settle them with the weights of ``train``."""
    return docs.withColumn("pii_spans", candidates(F.coalesce(F.col(text), F.lit(""))))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    built = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(
            F.when(
                s["start"] >= a["at"],
                F.concat(
                    a["out"],
                    F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                    F.get(names, s["kind"]),
                ),
            )
            .otherwise(a["out"])
            .alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), 2**31 - 1)),
    )
    return F.when(F.size(spans) > 0, built).otherwise(text)
