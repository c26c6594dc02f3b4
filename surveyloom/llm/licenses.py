"""License scan by template markup (operator 10).

A template is wording with markup: ``[[ ... ]]`` encloses optional wording, ``{{n}}`` stands for one to ``n``
replaceable words (a name, a year). A template compiles into an automaton over words: a state for every place in the
wording, an edge per mandatory word, a jump past each optional region, and a loop for replaceable words. A text
accepts the template where a run of the automaton from some word reaches its end, that is where the mandatory wording
stands exactly, with the optional and replaceable parts free. Runs start only at places of the template's anchor, its
first mandatory word, so most texts are passed over by a substring test.

Short licenses (MIT, ISC, BSD with two or three clauses) are held against their full wording; of the longer ones the
notices that point to them are.

Words are runs of digits, letters and all characters beyond ASCII, with A-Z taken as a-z; ASCII punctuation and white
space separate them. Three base phrases give base labels; templates add the label of the license they stand for.

``score`` is 1 where a template is accepted, else the largest part of a template's mandatory words that a run got
through, halved where no base phrase stands in the text, and 0 where no run passes two words.

Defined cases: a null text is an empty one, without words, labels or places; repeated rows each get a row; an empty
table gives an empty result; columns beyond the needed ones are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from surveyloom.llm.common import binary_list, map_slices, table, whole_text

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licenses and notices, fixed values.
_BSD_OPENING = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list "
    "of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright "
    "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution "
)
_BSD_END = (
    "this software is provided by {{8}} as is and any express or implied warranties including but not limited to the "
    "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{8}} "
    "be liable for any direct indirect incidental special exemplary or consequential damages including but not limited "
    "to procurement of substitute goods or services loss of use data or profits or business interruption however caused "
    "and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage"
)
TEMPLATES = {
    "mit-notice": "released under the [[terms of the]] mit license",
    "apache-2.0-notice": "licensed under the apache license version 2 0 [[the license]]",
    "apache-2.0-grant": "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license you may obtain a copy of the license at [[http www apache org licenses license 2 0]]",
    "gpl-3.0-notice": "this {{3}} is licensed under the [[gnu]] general public license version 3 [[or later]]",
    "gpl-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation either version {{1}} of the license or [[at "
    "your option]] any later version",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions the above "
    "copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or "
    "substantial portions of the software the software is provided as is without warranty of any kind express or "
    "implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
    "noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other "
    "liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
    "software or the use or other dealings in the software",
    "isc-text": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies the "
    "software is provided as is and {{4}} disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness in no event shall {{4}} be liable for any special direct indirect or "
    "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
    "of contract negligence or other tortious action arising out of or in connection with the use or performance of "
    "this software",
    "bsd-2-clause-text": _BSD_OPENING + _BSD_END,
    "bsd-3-clause-text": _BSD_OPENING + "[[3]] neither the name of {{8}} nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission " + _BSD_END,
    "cc-by-nc-4.0-notice": "licensed under [[a]] [[creative commons]] cc by nc 4 0 [[international]]",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache-2.0": "spdx license identifier apache 2 0",
}

_MARK = re.compile(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+")
# A-Z to a-z; other ASCII but digits and letters to space; bytes beyond ASCII stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Automaton:
    """States 0..n over the template's elements; ``edges[s]`` maps a word to a state, ``jumps`` need no word."""

    anchor: bytes = b""
    mandatory: int = 0
    edges: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    jumps: dict[int, list[int]] = field(default_factory=dict)
    wild: dict[int, int] = field(default_factory=dict)
    passed: list[int] = field(default_factory=lambda: [0])

    def add(self) -> int:
        self.edges.append({})
        self.passed.append(self.mandatory)
        return len(self.edges) - 1

    def closure(self, states: set[int]) -> set[int]:
        open_states = list(states)
        while open_states:
            for target in self.jumps.get(open_states.pop(), ()):
                if target not in states:
                    states.add(target)
                    open_states.append(target)
        return states

    def run(self, words: list[bytes], start: int) -> tuple[int, bool]:
        """Mandatory words passed from a start, and whether the end was reached."""
        end = len(self.edges) - 1
        states, best = self.closure({0}), 0
        for word in words[start:start + 4 * len(self.edges)]:
            after = {self.edges[s][word] for s in states if word in self.edges[s]}
            after.update(self.wild[s] for s in states if s in self.wild)
            states = self.closure(after)
            if not states:
                break
            best = max(best, max(self.passed[s] for s in states))
            if end in states:
                return self.mandatory, True
        return best, False


def compile_template(text: str) -> Automaton:
    """The automaton of a template, whose first element must be a mandatory word."""
    made, state, opened = Automaton(), 0, []
    for mark in _MARK.findall(text):
        if mark == "[[":
            opened.append(state)
        elif mark == "]]":
            made.jumps.setdefault(opened.pop(), []).append(state)
        elif mark.startswith("{{"):
            first = state
            for turn in range(int(mark[2:-2])):
                new = made.add()
                made.wild[state] = new
                if turn:
                    made.jumps.setdefault(state, []).append(-1)
                state = new
            made.jumps = {s: [state if t == -1 else t for t in ts] for s, ts in made.jumps.items()}
            if first == 0:
                raise ValueError("a template starts with a mandatory word")
        else:
            made.mandatory += not opened
            new = made.add()
            made.edges[state][mark.encode()] = new
            made.anchor = made.anchor or mark.encode()
            state = new
    if opened or not made.anchor or made.anchor not in made.edges[0]:
        raise ValueError("a template starts with a mandatory word and closes its regions")
    return made


class Scanner:
    """Base phrases and compiled templates, applied to one text at a time."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, base: dict[str, str] = BASE):
        self.base: dict[bytes, list[tuple[list[bytes], str]]] = {}  # by last word
        for phrase, label in base.items():
            words = phrase.encode().split()
            self.base.setdefault(words[-1], []).append((words, label))
        self.automata = [(label, compile_template(text)) for label, text in templates.items()]
        # a run that passes two words starts with the anchor and a word that may follow it
        self.pairs: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, one in self.automata:
            self.pairs.setdefault(one.anchor, []).append((label, one))

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score of a text."""
        folded = text.translate(_FOLD)
        words = folded.split()
        starts: list[int] = []
        found: set[str] = set()
        for last, phrases in self.base.items():
            for at in places(words, last) if last in folded else ():
                for phrase, label in phrases:
                    first = at - len(phrase) + 1
                    if first >= 0 and words[first: at + 1] == phrase:
                        starts.append(first)
                        found.add(label)
        labels, score = set(found), 0.0
        for anchor, automata in self.pairs.items():
            if anchor not in folded:
                continue
            for at in places(words, anchor):
                for label, one in automata:
                    passed, accepted = one.run(words, at)
                    if accepted:
                        labels.add(label)
                    if passed > 1:
                        score = max(score, 1.0 if accepted else passed / one.mandatory * (1.0 if found else 0.5))
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(found)), ",".join(sorted(labels)), score,
        )


def places(words: list[bytes], word: bytes) -> list[int]:
    """Places of a word."""
    found, at = [], -1
    try:
        while True:
            at = words.index(word, at + 1)
            found.append(at)
    except ValueError:
        return found


_SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
)
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]


def scanned(docs: DataFrame, keep: list[str], templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Add the scan's columns to those in ``keep``."""
    names = [part.split()[0] for part in _SCHEMA.split(", ")]
    scanner = Scanner(templates)

    def run(batch: pa.RecordBatch) -> dict:
        rows = [scanner.scan(text) for text in binary_list(batch.column("_text"))]
        return {name: pa.array([row[i] for row in rows], _TYPES[i]) for i, name in enumerate(names)}

    return map_slices(docs.select(*keep, whole_text().alias("_text")), "_text", _SCHEMA, run, keep)


def op10_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"), ["doc_id"])
