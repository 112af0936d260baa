"""License wording by templates compiled into token automata.

A template is license text with markup: `<<beginOptional>> ... <<endOptional>>` encloses words that may
be missing, `<<var;most=n>>` stands for up to n words of any kind. Everything else is mandatory and must
match word by word, in order. A template becomes an automaton over words whose states are a bit set; a
text is accepted from a word on if the automaton reaches its end. Runs start only where the template's
first mandatory words stand, so that long texts cost a search, not a run from each word.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case.

Base places are where the words of a phrase stand consecutively. A text's score is 1 if a template is
accepted, else 0.5 if it has a base place, else 0.

Defined results: a NULL or blank text has no words, labels or places (score 0); overlapping places and
matches all count; texts are scanned whole; repeated rows and NULL ids stay; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlake.llm.shared import prepare, required, text_bytes

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licenses, with the parts that may be missing or replaced marked.
TEMPLATES = {
    "mit-notice": "released under the MIT License",
    "apache-2.0-notice": "licensed under the Apache License <<beginOptional>>the License<<endOptional>> Version 2.0",
    "gpl-3.0-notice": (
        "This work is licensed under the GNU General Public License "
        "<<beginOptional>>as published by the Free Software Foundation<<endOptional>> "
        "<<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>or later<<endOptional>>"
    ),
    "cc-by-nc-4.0-notice": (
        "licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY NC 4.0 "
        "<<beginOptional>>International License<<endOptional>>"
    ),
    "reserved": "all rights reserved",
    "mit-text": (
        "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the Software to deal in the Software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the Software and to "
        "permit persons to whom the Software is furnished to do so subject to the following conditions The above "
        "copyright notice and this permission notice <<beginOptional>>including the next paragraph<<endOptional>> "
        "shall be included in all copies or substantial portions of the Software THE SOFTWARE IS PROVIDED AS IS "
        "WITHOUT WARRANTY OF ANY KIND EXPRESS OR IMPLIED INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT IN NO EVENT SHALL <<var;most=30>> BE "
        "LIABLE FOR ANY CLAIM DAMAGES OR OTHER LIABILITY WHETHER IN AN ACTION OF CONTRACT TORT OR OTHERWISE ARISING "
        "FROM OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"
    ),
    "isc-text": (
        "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies THE "
        "SOFTWARE IS PROVIDED AS IS AND <<var;most=30>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"
    ),
    "apache-2.0-header": (
        "Licensed under the Apache License Version 2.0 the License you may not use this file except in compliance "
        "with the License You may obtain a copy of the License at <<beginOptional>>http www apache org licenses "
        "LICENSE 2.0<<endOptional>> Unless required by applicable law or agreed to in writing software distributed "
        "under the License is distributed on an AS IS BASIS WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND either "
        "express or implied"
    ),
}

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_EDGE = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;most=\d+)>>")
_IS_WORD = np.ones(256, bool)
_IS_WORD[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass(frozen=True)
class Part:
    """A mandatory word, an optional part, or up to `most` words of any kind."""

    word: bytes | None = None
    optional: tuple[Part, ...] = ()
    most: int = 0


def parse(template: str) -> tuple[Part, ...]:
    stack: list[list[Part]] = [[]]
    for i, piece in enumerate(_MARKUP.split(template)):
        if i % 2 == 0:
            stack[-1] += [Part(word=w) for w in words_of(piece)]
        elif piece == "beginOptional":
            stack.append([])
        elif piece == "endOptional":
            inner = tuple(stack.pop())
            stack[-1].append(Part(optional=inner))
        else:
            stack[-1].append(Part(most=int(piece.split("=")[1])))
    if len(stack) != 1:
        raise ValueError("an optional part is not closed")
    return tuple(stack[0])


class Automaton:
    """States are positions in the flattened template, kept as bits of a number."""

    def __init__(self, template: str):
        parts = parse(template)
        self.words: list[bytes | None] = []  # what the step from each state takes; None takes any word
        self.skips: list[tuple[int, int]] = []  # (from, to) without a word
        self._flatten(parts)
        self.accept = 1 << len(self.words)
        self.on: dict[bytes, int] = {}
        self.any = 0
        for i, word in enumerate(self.words):
            if word is None:
                self.any |= 1 << i
            else:
                self.on[word] = self.on.get(word, 0) | 1 << i
        self.start = self._closed(1)
        head = []
        for part in parts:
            if part.word is None or len(head) == 2:
                break
            head.append(part.word)
        if not head:
            raise ValueError("a template begins with a mandatory word")
        self.head = re.compile(rb"(?<!" + _EDGE + rb")" + _GAP.join(map(re.escape, head)) + rb"(?!" + _EDGE + rb")")

    def _flatten(self, parts) -> None:
        for part in parts:
            if part.word is not None:
                self.words.append(part.word)
                continue
            begin = len(self.words)
            if part.optional:
                self._flatten(part.optional)
                self.skips.append((begin, len(self.words)))
            else:
                self.words += [None] * part.most
                self.skips += [(begin + i, begin + part.most) for i in range(part.most)]

    def _closed(self, states: int) -> int:
        # skips lead forward; inner ones of nested parts come first, so ordered passes reach all
        for a, b in sorted(self.skips):
            if states >> a & 1:
                states |= 1 << b
        return states

    def longest(self, words, at: int) -> int:
        """End of the longest accepted run of words from `at` on, or -1."""
        states, end = self.start, -1
        while at < len(words):
            taken = states & (self.on.get(words[at], 0) | self.any)
            if not taken:
                break
            at += 1
            states = self._closed(taken << 1)
            if states & self.accept:
                end = at
        return end


class Scanner:
    def __init__(self, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None):
        self.automata = {label: Automaton(t) for label, t in (TEMPLATES if templates is None else templates).items()}
        self.phrases = {
            label: self._phrase(phrase)
            for phrase, label in (PHRASES if phrases is None else phrases).items()
        }

    @staticmethod
    def _phrase(phrase: str):
        words = words_of(phrase)
        pattern = _GAP.join(map(re.escape, words)) + rb"(?!" + _EDGE + rb")"
        if any(words[:n] == words[-n:] for n in range(1, len(words))):
            pattern = rb"(?=(" + pattern + rb"))"  # its places may overlap, so a match takes no words
        return re.compile(rb"(?<!" + _EDGE + rb")" + pattern)

    def scan(self, texts: list[bytes]):
        """Per text: n_words, n_base, first_word, last_word, base_labels, labels, score, evidence."""
        lowered = [t.lower() for t in texts]
        lengths = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
        ends = np.cumsum(lengths)
        buffer = b"\n".join(lowered) + b"\n"
        inside = _IS_WORD[np.frombuffer(buffer, np.uint8)] if lowered else np.zeros(0, bool)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.flatnonzero(first)
        text_of_word = np.searchsorted(ends, starts, side="right")
        n_words = np.bincount(text_of_word, minlength=len(texts))
        offset = np.cumsum(n_words) - n_words
        rows = [
            {"n_words": n, "n_base": 0, "first_word": None, "last_word": None, "base": set(), "extra": set(), "evidence": []}
            for n in n_words.tolist()
        ]

        def owner(begin: int, end: int) -> int | None:
            i = int(np.searchsorted(ends, begin, side="right"))
            return i if end <= ends[i] else None  # None: it runs on into the next text

        for label, pattern in self.phrases.items():
            for match in pattern.finditer(buffer):
                i = owner(match.start(), match.end(match.lastindex or 0))
                if i is None:
                    continue
                row, word = rows[i], int(np.searchsorted(starts, match.start())) - int(offset[i])
                row["n_base"] += 1
                row["base"].add(label)
                row["first_word"] = word if row["first_word"] is None else min(word, row["first_word"])
                row["last_word"] = word if row["last_word"] is None else max(word, row["last_word"])
        split: dict[int, list[bytes]] = {}
        for label, automaton in self.automata.items():
            for match in automaton.head.finditer(buffer):
                i = owner(match.start(), match.end())
                if i is None:
                    continue
                if i not in split:
                    split[i] = _WORD.findall(lowered[i])
                word = int(np.searchsorted(starts, match.start())) - int(offset[i])
                end = automaton.longest(split[i], word)
                if end >= 0:
                    rows[i]["extra"].add(label)
                    rows[i]["evidence"].append(f"{label}:{word}-{end}")
        return rows


_FOUND = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "evidence array<string>"
)


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, evidence).

    evidence has an accepted template's label with its first word and the end, for each match.
    """
    prepare(docs.sparkSession)

    def run(batches):
        scanner = Scanner(templates)
        names = ["doc", *(f.split()[0] for f in _FOUND.split(", "))]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
        for batch in batches:
            columns = [[] for _ in kinds]
            for r in scanner.scan(batch.column(1).to_pylist()):
                score = 1.0 if r["extra"] else 0.5 if r["n_base"] else 0.0
                values = (
                    r["n_words"], r["n_base"], r["first_word"], r["last_word"], ",".join(sorted(r["base"])),
                    ",".join(sorted(r["base"] | r["extra"])), score, r["evidence"],
                )
                for column, value in zip(columns, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names=names)

    narrow = required(docs, id_column, text_column).select(
        F.col(f"`{id_column}`").cast("long").alias("doc"), text_bytes(text_column).alias("bytes")
    )
    return narrow.mapInArrow(run, f"doc long, {_FOUND}").withColumnRenamed("doc", id_column)


def template_pattern(template: str) -> str:
    """The template as a regular expression over lower-case text, for SQL."""
    gap, word = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def of(parts) -> str:
        # each element brings the gap before it
        out = ""
        for part in parts:
            if part.word is not None:
                out += f"{gap}{re.escape(part.word.decode())}"
            elif part.optional:
                out += f"(?:{of(part.optional)})?"
            else:
                out += f"(?:{gap}{word}){{0,{part.most}}}"
        return out

    return f"(?:^|{gap}){of(parse(template)).removeprefix(gap)}(?:$|{gap})"
