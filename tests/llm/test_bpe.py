"""Ids and decoded texts against the tokenizers library."""

import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioscope.llm import bpe
from folioscope.plans.registry import QUERIES
from tests.llm.helpers import SMALL, documents, tables

PATH = public_tokenizers.path("word_bpe_49k.json")
CODEC = bpe.Codec(bpe.load_vocabulary(PATH))
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_padding()
LIBRARY.no_truncation()


def wanted(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def same(text):
    ids = CODEC.encode(text)
    assert (ids, CODEC.decode(ids)) == wanted(text), text


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"])))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("a aa aaa ab ba s t th he in an 'S 're <| |> Σ ς İ é ñ ß ́ ١ ²".split()), max_size=30).map("".join))
def test_repeated_and_joined_pieces(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(sorted(CODEC.vocabulary.usable)), min_size=1, max_size=4))
def test_joined_tokens(parts):
    same("".join(parts).replace(bpe.END, ""))


HARD = [
    None,
    "",
    " \n\t　",
    "a<|endoftext|>b <|startoftext|><|ENDOFTEXT|>",
    "x\x1cy\x1fz\x85w\xa0v​q",
    "I'LL don't 'tis '''ve",
    "naïve naïve ＡＢＣ ½ Ⅷ ٣ 漢字 😀👩‍👩‍👧 ́ ΟΔΟΣ İstanbul",
    "a" * 5000 + " " + "!?" * 3000,
    "the " * 20_000,
]


def test_query_on_hard_cases_and_small_tables(spark, tmp_path):
    texts = HARD + HARD[3:5]
    docs = documents(spark, texts).selectExpr("*", "1 AS bpe_n", "2 AS n_tokens")
    cases = [(tables(tmp_path, documents=docs), dict(enumerate(texts)))]
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    cases.append((SMALL, dict(map(tuple, rows))))
    for folder, by_id in cases:
        got = QUERIES["op10_bpe"](spark, folder).collect()
        assert len(got) == len(by_id)
        for r in got:
            ids, decoded = wanted(by_id[r.doc_id])
            sums = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
            assert [r.n_tokens, r.ids_sha256, r.decoded_sha256] == [len(ids), *sums], by_id[r.doc_id]


def test_empty_table(spark, tmp_path):
    assert QUERIES["op10_bpe"](spark, tables(tmp_path, documents=documents(spark, []))).count() == 0


def test_a_full_memo_forgets_rare_words_and_keeps_the_others():
    codec = bpe.Codec(CODEC.vocabulary)
    codec._word_memo, codec._chunk_memo = bpe.Memo(20), bpe.Memo(20)
    words = [f"w{i}q," for i in range(200)]
    for word in words:
        ids = codec.encode(f"the, {word}")
        assert (ids, codec.decode(ids)) == wanted(f"the, {word}")
    for memo in (codec._word_memo, codec._chunk_memo):
        assert len(memo.young) <= 20 and len(memo.old) <= 20
    # a word met after the memo was full is remembered, too
    assert codec._chunk_memo.get("the,") and codec._chunk_memo.get(words[-1])
    assert codec._chunk_memo.get(words[0]) is None
