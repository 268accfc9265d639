"""License scans by template markup compiled into token automata.

A template is the wording of a license or notice with marked regions: optional ones, which may be
missing, and replaceable ones, which accept any of some wordings, one word of a pattern, or a number
of arbitrary words. Compiled, it is a small automaton over words; a text is accepted where its words
run through the automaton from the first mandatory word to the end, so every mandatory word must be
there in its place. The automaton is started only where its first mandatory words stand, which is a
byte search over the normalised text.

Fixed phrases are found the same way and give base labels; accepted templates add their own labels.
The score is the best share of mandatory words that any template matched before it failed.

Defined results: a null or empty text has no words, no labels and score 0; all places count, also
those that share a word; repeated rows are scanned alike; an empty table gives no rows; columns
with clashing names are untouched, the added ones carry the prefix ``lic_``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import takewhile

from pyspark.sql import DataFrame

from folioscope.llm.batches import pieces

# Phrases of the contract and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license wordings. << >> marks a region: ?...| optional text, =a|b| alternatives,
# ~pattern| one word, *n| up to n arbitrary words.
TEMPLATES = {
    "mit-notice": "released under the <<?terms of the>> mit license",
    "gpl-notice": "<<?this work is>> licensed under the gnu general public license "
    "<<?version <<~[0-9]+>> <<?or <<=later|any later version>>>>>>",
    "apache-notice": "licensed under the apache license <<?version <<~[0-9]+>> <<?<<~[0-9]+>>>>>>",
    "cc-by-nc-notice": "licensed under <<?a>> <<?creative commons>> cc by nc <<?<<=sa|nd>>>> "
    "<<?<<~[0-9]+>> <<?<<~[0-9]+>>>>>>",
    "cc-by-notice": "licensed under <<?a>> <<?creative commons>> cc by <<?<<=sa|nd>>>> <<~[0-9]+>> "
    "<<?<<~[0-9]+>>>>",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of "
    "<<=this software and associated documentation files|this source file>> the software to deal in "
    "the software without restriction including without limitation the rights to use copy modify "
    "merge publish distribute sublicense and or sell copies of the software and to permit persons "
    "to whom the software is furnished to do so subject to the following conditions the above "
    "copyright notice and this permission notice <<?including the next paragraph>> shall be "
    "included in all copies or substantial portions of the software the software is provided as is "
    "without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall "
    "<<=the authors or copyright holders|<<*12>>>> be liable for any claim damages or other liability "
    "whether in an action of contract tort or otherwise arising from out of or in connection with the "
    "software or the use or other dealings in the software",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met <<?1>> redistributions of source code "
    "must retain the above copyright notice this list of conditions and the following disclaimer "
    "<<?2>> redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution <<?<<?3>> neither the name of <<*20>> nor the names of its contributors "
    "may be used to endorse or promote products derived from this software without specific prior "
    "written permission>> this software is provided by <<*12>> as is and any express or implied "
    "warranties including but not limited to the implied warranties of merchantability and fitness "
    "for a particular purpose are disclaimed in no event shall <<*12>> be liable for any direct "
    "indirect incidental special exemplary or consequential damages including but not limited to "
    "procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even if "
    "advised of the possibility of such damage",
    "isc-text": "permission to use copy modify <<=and|and or>> distribute this software for any purpose "
    "with or without fee is hereby granted <<?provided that the above copyright notice and this "
    "permission notice appear in all copies>> the software is provided as is and <<*8>> disclaims all "
    "warranties with regard to this software including all implied warranties of merchantability and "
    "fitness in no event shall <<*8>> be liable for any special direct indirect or consequential "
    "damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
    "of contract negligence or other tortious action arising out of or in connection with the use or "
    "performance of this software",
    "zlib-text": "this software is provided as is without any express or implied warranty in no event "
    "will the authors be held liable for any damages arising from the use of this software permission "
    "is granted to anyone to use this software for any purpose including commercial applications and to "
    "alter it and redistribute it freely subject to the following restrictions <<?1>> the origin of "
    "this software must not be misrepresented you must not claim that you wrote the original software "
    "if you use this software in a product an <<=acknowledgment|acknowledgement>> in the product "
    "documentation would be appreciated but is not required <<?2>> altered source versions must be "
    "plainly marked as such and must not be misrepresented as being the original software <<?3>> this "
    "notice may not be removed or altered from any source distribution",
    "boost-text": "permission is hereby granted free of charge to any person or organization obtaining a "
    "copy of the software and accompanying documentation covered by this license the software to use "
    "reproduce display distribute execute and transmit the software and to prepare derivative works of "
    "the software and to permit third parties to whom the software is furnished to do so all subject to "
    "the following the copyright notices in the software and this entire statement including the above "
    "license grant this restriction and the following disclaimer must be included in all copies of the "
    "software in whole or in part and all derivative works of the software unless such copies or "
    "derivative works are solely in the form of machine executable object code generated by a source "
    "language processor the software is provided as is without warranty of any kind express or implied "
    "including but not limited to the warranties of merchantability fitness for a particular purpose "
    "title and non infringement in no event shall the copyright holders or anyone distributing the "
    "software be liable for any damages or other liability whether in contract tort or otherwise "
    "arising from out of or in connection with the software or the use or other dealings in the software",
    "unlicense-text": "this is free and unencumbered software released into the public domain anyone is "
    "free to copy modify publish use compile sell or distribute this software either in source code "
    "form or as a compiled binary for any purpose commercial or non commercial and by any means in "
    "jurisdictions that recognize copyright laws the author or authors of this software dedicate any "
    "and all copyright interest in the software to the public domain we make this dedication for the "
    "benefit of the public at large and to the detriment of our heirs and successors we intend this "
    "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
    "this software under copyright law the software is provided as is without warranty of any kind "
    "express or implied including but not limited to the warranties of merchantability fitness for a "
    "particular purpose and noninfringement in no event shall the authors be liable for any claim "
    "damages or other liability whether in an action of contract tort or otherwise arising from out of "
    "or in connection with the software or the use or other dealings in the software",
    "mpl-header": "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
    "copy of the mpl was not distributed with this file you can obtain one at",
    "apache-header": "licensed under the apache license version 2 0 the license you may not use this "
    "file except in compliance with the license you may obtain a copy of the license at <<*12>> "
    "unless required by applicable law or agreed to in writing software distributed under the "
    "license is distributed on an as is basis without warranties or conditions of any kind either "
    "express or implied see the license for the specific language governing permissions and "
    "limitations under the license",
    "gpl-header": "<<=this program|this file|<<*6>>>> is free software you can redistribute it and or "
    "modify it under the terms of the gnu <<?lesser>> general public license as published by the "
    "free software foundation either version <<~[0-9]+>> of the license or at your option any later "
    "version",
}
ANCHOR_WORDS = 3

# A byte of a word stays, A-Z become a-z, the rest become blanks.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def normalise(text: bytes) -> tuple[bytes, int]:
    """The words of a text between single blanks, one blank around them, and their number."""
    words = text.translate(_WORD_BYTES).split()
    return b" " + b"".join(w + b" " for w in words), len(words)


@dataclass
class Automaton:
    """States are numbered; ``steps`` lead on by a word, ``skips`` without one."""

    steps: list = field(default_factory=lambda: [[]])
    skips: list = field(default_factory=lambda: [[]])
    mandatory: list = field(default_factory=list)  # words every accepted text has, in order
    opening: list = field(default_factory=list)  # those of them before the first region
    final: int = 0

    def state(self) -> int:
        self.steps.append([])
        self.skips.append([])
        return len(self.steps) - 1

    def add_word(self, at: int, test, required: bool) -> int:
        to = self.state()
        self.steps[at].append((test, to, required))
        return to

    def closure(self, states: dict[int, int]) -> dict[int, int]:
        """States reached without a word; each keeps the most mandatory words matched so far."""
        todo = list(states.items())
        while todo:
            at, matched = todo.pop()
            for to in self.skips[at]:
                if states.get(to, -1) < matched:
                    states[to] = matched
                    todo.append((to, matched))
        return states

    def run(self, words: Iterator[bytes]) -> tuple[bool, float]:
        """Whether a beginning of ``words`` is accepted, and the share of mandatory words met."""
        states, best = self.closure({0: 0}), 0
        accepted = self.final in states
        for word in words:
            following: dict[int, int] = {}
            for at, matched in states.items():
                for test, to, required in self.steps[at]:
                    if test is None or (test == word if isinstance(test, bytes) else test(word)):
                        following[to] = max(following.get(to, -1), matched + required)
            states = self.closure(following)
            if not states:
                break
            best = max(best, max(states.values()))
            accepted = accepted or self.final in states
        whole = len(self.mandatory)
        return accepted, min(1.0, best / whole) if whole else 0.0


def _regions(markup: str) -> list:
    """Nested lists of words and regions; a region is ``(kind, content)``."""
    parts = re.findall(r"<<[?=~*]|>>|\||[^\s|<>]+", markup)

    def parse(at: int) -> tuple[list, int]:
        out: list = [[]]
        while at < len(parts):
            part = parts[at]
            if part == ">>":
                return out, at + 1
            if part == "|":
                out.append([])
                at += 1
            elif part.startswith("<<"):
                inner, at = parse(at + 1)
                out[-1].append((part[2], inner))
            else:
                out[-1].append(part)
                at += 1
        return out, at

    return parse(0)[0][0]


def compile_template(markup: str) -> Automaton:
    auto = Automaton()

    def sequence(items: list, at: int, required: bool) -> int:
        for item in items:
            if isinstance(item, str):
                word = item.encode()
                at = auto.add_word(at, word, required)
                if required:
                    auto.mandatory.append(word)
                continue
            kind, branches = item
            if kind == "?":
                end = sequence(branches[0], at, False)
                auto.skips[at].append(end)
                at = end
            elif kind == "=":
                end = auto.state()
                for branch in branches:
                    auto.skips[sequence(branch, at, False)].append(end)
                at = end
            elif kind == "~":
                pattern = re.compile(branches[0][0].encode())
                at = auto.add_word(at, pattern.fullmatch, False)
            else:
                end = auto.state()
                auto.skips[at].append(end)
                for _ in range(int(branches[0][0])):
                    at = auto.add_word(at, None, False)
                    auto.skips[at].append(end)
                at = end
        return at

    # what stands before the first mandatory word cannot decide acceptance
    items = _regions(markup)
    while items and not isinstance(items[0], str):
        items = items[1:]
    auto.opening = [w.encode() for w in takewhile(lambda item: isinstance(item, str), items)]
    auto.final = sequence(items, 0, True)
    return auto


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.templates = []
        for label, markup in templates.items():
            auto = compile_template(markup)
            anchor = b" " + b" ".join(auto.opening[:ANCHOR_WORDS]) + b" "
            self.templates.append((label, auto, anchor))

    @staticmethod
    def places(text: bytes, phrase: bytes) -> Iterator[tuple[int, int]]:
        """Offset and word number of each place of a phrase, in one pass."""
        at, word, counted = text.find(phrase), 0, 0
        while at >= 0:
            word += text.count(b" ", counted, at)
            counted = at
            yield at, word
            at = text.find(phrase, at + 1)

    def scan(self, raw: bytes | None) -> tuple:
        text, n_words = normalise(raw or b"")
        starts, base, score = [], set(), 0.0
        for phrase, label in self.phrases:
            for _, word in self.places(text, phrase):
                starts.append(word)
                base.add(label)
        added: dict[tuple[str, int], None] = {}
        for label, auto, anchor in self.templates:
            for at, word in self.places(text, anchor):
                words = (m.group() for m in re.finditer(rb"[^ ]+", memoryview(text)[at:]))
                accepted, share = auto.run(words)
                score = max(score, 1.0 if accepted else share)
                if accepted:
                    added[label, word] = None
        labels = sorted(base | {label for label, _ in added})
        return (
            n_words,
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(labels),
            score,
            [{"label": label, "word": word} for label, word in added],
        )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts, labels, score and ``lic_places`` of accepted templates."""
    names = "n_words n_base first_word last_word base_labels labels score places".split()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner()
        place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), place]
        for batch in pieces(batches):
            values = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            found = zip(*map(scanner.scan, values))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, k) for c, k in zip(found, kinds))],
                names=[*batch.schema.names, *(f"lic_{n}" for n in names)],
            )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(
        run,
        f"{columns}, lic_n_words bigint, lic_n_base bigint, lic_first_word bigint, "
        "lic_last_word bigint, lic_base_labels string, lic_labels string, lic_score double, "
        "lic_places array<struct<label: string, word: bigint>>",
    )
