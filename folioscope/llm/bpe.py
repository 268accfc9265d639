r"""BPE encoding by dynamic programming over prefixes, and decoding.

Merges are applied in the order of their rank, and each merge joins symbols of lower rank, so the
encoding of a prefix that ends at a token border is the beginning of the whole encoding. Every prefix
of a word therefore has one last token: the token that ends there and is compatible with the last
token of the prefix before it. An Aho-Corasick automaton, the suffix automaton of the vocabulary,
yields the tokens that end at each place; compatibility of two neighbours is a test on the halves
they were merged from; back-pointers give the ids.

Compatible means that no merge crosses the border. A symbol on the right edge of the left token and
one on the left edge of the right token meet if both are still unmerged when their own merge comes
up. Equal ranks are settled from left to right.

Texts are split as the vocabulary file says: special tokens, NFC, white space, lower case, words.
Decoding joins the tokens with single blanks, as a file without a decoder asks for.

Letters and case are those of the Unicode tables installed here; characters assigned after Unicode
15.1 may be split or lower-cased otherwise than by a library with other tables.

Defined results: a null or empty text, or one of white space, has no ids and decodes to the empty
string; repeated rows are encoded alike; an empty table gives no rows; columns with clashing names
are untouched, the added ones carry the prefix ``bpe_``.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from folioscope.llm.batches import pieces

WORD_END = "</w>"
END = "\n"  # stands for the end of a word inside the automaton; byte signs never include it
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# entries of the younger half of a memo; the older half is as large
RUN_MEMO_SIZE = 120_000
WORD_MEMO_SIZE = 60_000
PAIR_MEMO_SIZE = 250_000


def byte_signs() -> list[str]:
    """The visible sign of every byte: printable Latin-1 stands for itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Vocabulary:
    """Tables of a word-level BPE file: symbols, merges, edges and the automaton."""

    def __init__(self, content: str):
        file = json.loads(content)
        model = file["model"]
        if model["end_of_word_suffix"] != WORD_END or file["decoder"] is not None:
            raise ValueError("expected words with ends and no decoder")
        self.names = {i: t for t, i in model["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in file["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        # the splitting pattern of the file; only its possessive form is ours
        self.pattern = next(
            p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        ids = model["vocab"]
        self.halves: dict[int, tuple[int, int]] = {}
        self.ranks: dict[tuple[int, int], int] = {}
        self.rank_of: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            joined = ids[left + right]
            pair = (ids[left], ids[right])
            if any(self.rank_of.get(p, -1) >= rank for p in pair) or joined in self.halves:
                raise ValueError("merges must join symbols made by earlier merges, each once")
            self.halves[joined], self.ranks[pair], self.rank_of[joined] = pair, rank, rank
        self.usable = self._usable(ids)
        self.pairs: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self._n_pairs = 0

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols on one edge of a token with the rank of the merge that ends each."""
        edge, ends = [], 1 << 60
        while True:
            edge.append((token, ends))
            if token not in self.halves:
                return edge
            ends, token = self.rank_of[token], self.halves[token][side]

    def _crosses(self, a: int, b: int, before: int) -> bool:
        ranks = self.ranks
        edge_of_b = self._edge(b, 0)
        for x, x_ends in self._edge(a, 1):
            for y, y_ends in edge_of_b:
                rank = ranks.get((x, y))
                if rank is not None and rank < before and rank < x_ends and rank <= y_ends:
                    return True
        return False

    def _usable(self, ids: dict) -> dict[str, int]:
        """Tokens that their own text encodes to, as strings over byte signs and ``END``."""
        usable = {i for i in ids.values() if i not in self.halves}
        for token, (a, b) in self.halves.items():  # in the order of rank
            if a in usable and b in usable and not self._crosses(a, b, self.rank_of[token]):
                usable.add(token)
        text = {}
        for name, i in ids.items():
            if i in usable:
                text[name[: -len(WORD_END)] + END if name.endswith(WORD_END) else name] = i
        return text

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs[a].get(b)
        if known is None:
            known = not self._crosses(a, b, 1 << 60)
            if self._n_pairs < PAIR_MEMO_SIZE:
                self.pairs[a][b] = known
                self._n_pairs += 1
        return known


class Memo:
    """What was met lately: a full younger half becomes the older one, and that is forgotten.

    Words that come back are moved to the younger half, so rare ones cannot fill the memo for good.
    """

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}

    def get(self, key: str) -> tuple[str, str] | None:
        entry = self.young.get(key)
        if entry is None and (entry := self.old.get(key)) is not None:
            self.put(key, entry)
        return entry

    def put(self, key: str, entry: tuple[str, str]) -> None:
        if len(key) >= 64:
            return
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = entry


class Codec:
    """Encoder and decoder of one vocabulary, with bounded memos of words met."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        import regex

        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for text, token in vocabulary.usable.items():
            self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.signs = str.maketrans({chr(b): s for b, s in enumerate(byte_signs())})
        self.words = regex.compile(vocabulary.pattern)
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")
        self.spaces = re.compile(f"[{SPACES}]+")
        self.numbers = {i: str(i) for i in vocabulary.names}
        self._word_memo, self._chunk_memo = Memo(WORD_MEMO_SIZE), Memo(RUN_MEMO_SIZE)

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word, from the last token of every prefix."""
        signs = (word if word.isascii() else word.encode().decode("latin-1")).translate(self.signs) + END
        # the last token of the prefix up to each place; the item at -1 stands for the empty prefix
        last: list[int | None] = [None] * len(signs) + [-1]
        sizes = [0] * len(signs)
        compatible, pairs = self.vocabulary.compatible, self.vocabulary.pairs
        for end, (token, size) in self.automaton.iter(signs):
            if last[end] is None and (before := last[end - size]) is not None:
                if before >= 0:
                    fits = pairs[before].get(token)
                    if not (compatible(before, token) if fits is None else fits):
                        continue
                last[end], sizes[end] = token, size
        ids, at = [], len(signs) - 1
        while at >= 0:
            ids.append(last[at])
            at -= sizes[at]
        ids.reverse()
        return ids

    def _forms(self, ids: list[int]) -> tuple[str, str]:
        return " ".join([self.numbers[i] for i in ids]), self.decode(ids)

    def _encode_chunk(self, chunk: str) -> tuple[str, str]:
        """Ids of a run without white space, in their decimal and decoded forms."""
        if (entry := self._chunk_memo.get(chunk)) is not None:
            return entry
        if chunk.isascii():
            text = chunk.lower()
        else:
            text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        found, memo = self.words.findall(text), self._word_memo
        if len(found) == 1:
            # a run that is one word is remembered as a run, not twice
            word = found[0]
            entry = memo.young.get(word) or memo.get(word) or self._forms(self.encode_word(word))
        else:
            numbers, names = [], []
            for word in found:
                form = memo.young.get(word) or memo.get(word)
                if form is None:
                    form = self._forms(self.encode_word(word))
                    memo.put(word, form)
                numbers.append(form[0])
                names.append(form[1])
            entry = (" ".join(numbers), " ".join(names))
        self._chunk_memo.put(chunk, entry)
        return entry

    def chunks(self, text: str | None) -> list[tuple[str, str]]:
        """Decimal and decoded ids of the runs of a text, those that give no ids left out."""
        known, found = self._chunk_memo.young.get, []
        for part in self.special.split(text or "") if "<|" in (text or "") else [text or ""]:
            if part in self.vocabulary.special:
                found.append(self._forms([self.vocabulary.special[part]]))
                continue
            # str.split also cuts at four control signs that are not white space here
            plain = part.isprintable() or not re.search("[\x1c-\x1f]", part)
            runs = part.split() if plain else filter(None, self.spaces.split(part))
            found += [known(run) or self._encode_chunk(run) for run in runs]
        # a run that the pattern drops whole adds neither an id nor a blank
        return [entry for entry in found if entry[0]]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for numbers, _ in self.chunks(text) for i in numbers.split()]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.vocabulary.names.__getitem__, ids))


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", with_ids: bool = True):
    """``docs`` with ``bpe_n``, ``bpe_ids_sha256`` and ``bpe_decoded_sha256``, and ``bpe_ids``.

    The vocabulary is one file of some megabytes and is broadcast; each worker process builds its
    codec once, kept beside the broadcast value.
    """
    sent = docs.sparkSession.sparkContext.broadcast({"vocabulary": vocabulary})

    def encoded(codec: Codec, batch):
        import hashlib

        import pyarrow as pa

        sizes, ids_sums, text_sums, ids = [], [], [], []
        for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
            numbers, names = zip(*entries) if (entries := codec.chunks(value)) else ((), ())
            joined, decoded = " ".join(numbers), " ".join(names)
            sizes.append(joined.count(" ") + 1 if joined else 0)
            ids_sums.append(hashlib.sha256(joined.encode()).hexdigest())
            text_sums.append(hashlib.sha256(decoded.encode()).hexdigest())
            if with_ids:
                ids.append(np.fromstring(joined, np.int32, sep=" "))
        more = [pa.array(sizes, pa.int64()), pa.array(ids_sums), pa.array(text_sums)]
        names = ["bpe_n", "bpe_ids_sha256", "bpe_decoded_sha256"]
        if with_ids:
            more.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("bpe_ids")
        return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])

    def run(batches: Iterator) -> Iterator:
        held = sent.value
        if "codec" not in held:
            held["codec"] = Codec(held["vocabulary"])
        codec = held["codec"]
        for batch in pieces(batches):
            yield encoded(codec, batch)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    shape = f"{columns}, bpe_n bigint, bpe_ids_sha256 string, bpe_decoded_sha256 string"
    return docs.mapInArrow(run, shape + (", bpe_ids array<int>" if with_ids else ""))
