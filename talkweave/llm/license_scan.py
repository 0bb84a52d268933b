"""License scans by template markup.

A template is license wording in which ``<<beginOptional>>...<<endOptional>>`` may be missing and
``<<var;name="...";match=N>>`` stands for any 0 to N words. It is compiled to an automaton over words; it accepts a
place of a text if all its mandatory wording stands there exactly, word by word (case, punctuation and white space do not count).
The phrases of the base labels are templates without markup.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm import arrays

WORDS = arrays.byte_class(arrays.NOT_ALPHANUMERIC, lower=True)

# --- Fixed values: phrases of the base labels, and public license notices with their markup. ---

BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""

TEMPLATES = {
    "mit-notice": "<<beginOptional>>Released<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name="subject";match=8>> to deal in the Software without restriction, including without limitation the rights to
        use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of the Software. """ + _WARRANTY,
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0<<beginOptional>> (the \"License\")<<endOptional>>",
    "gpl-notice": """<<beginOptional>>This work is<<endOptional>> licensed under the
        <<beginOptional>>terms of the<<endOptional>> GNU General Public License<<beginOptional>>, version
        <<var;name="version";match=2>><<endOptional>>""",
    "gpl-3.0-notice": """licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License
        <<beginOptional>>as published by the Free Software Foundation<<endOptional>>, <<beginOptional>>either<<endOptional>> version 3""",
    "gpl-text": """you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation<<var;name="version";match=20>>""",
    "cc-by-nc-4.0": """licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>>
        <<beginOptional>>Attribution-NonCommercial<<endOptional>> CC BY-NC 4.0""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>>
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution.""",
}

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


@dataclass
class Automaton:
    """States 0 to ``last``; ``steps[s]``: (word or None for any, next state); ``free[s]``: states reached without a word."""

    steps: list[list[tuple[str | None, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])

    @property
    def last(self) -> int:
        return len(self.steps) - 1

    def grow(self, word: str | None) -> None:
        self.steps[-1].append((word, self.last + 1))
        self.steps.append([])
        self.free.append([])

    def closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    @cached_property
    def starts(self) -> tuple[set[str], bool]:
        """The words a match can begin with, and whether any word can."""
        words = {w for s in self.closure({0}) for w, _ in self.steps[s]}
        return words - {None}, None in words

    def longest(self, words: list[str], at: int) -> int | None:
        """The end of the longest match that begins at word ``at``; None if there is none."""
        now, end = self.closure({0}), None
        if self.last in now:
            end = at
        for k in range(at, len(words)):
            now = self.closure({t for s in now for w, t in self.steps[s] if w is None or w == words[k]})
            if not now:
                break
            if self.last in now:
                end = k + 1
        return end


def compile_template(markup: str) -> Automaton:
    """Words, optional and replaceable regions of a template as an automaton. Optional regions nest."""
    made, opened = Automaton(), []
    for i, part in enumerate(_MARKUP.split(markup)):
        if i % 2 == 0:
            for word in _WORD.findall(lower_ascii(part)):
                made.grow(word)
        elif part == "beginOptional":
            opened.append(made.last)
        elif part == "endOptional":
            made.free[opened.pop()].append(made.last)
        else:
            most = re.search(r"match=\"?(\d+)", part)
            begin = made.last
            for _ in range(int(most[1]) if most else 10):
                made.grow(None)
            for s in range(begin, made.last):
                made.free[s].append(made.last)
    if opened:
        raise ValueError("an optional region is not closed")
    if made.last in made.closure({0}) or made.starts[1]:
        raise ValueError("a template must begin with a word and hold mandatory wording")
    return made


def _hash_of(word: str) -> np.uint64:
    data = pa.array([word], pa.large_string())
    return next(arrays.word_hashes(w)[0] for w in arrays.words_of(data, WORDS))


class Scanner:
    """All templates; candidate starts come from hashes of two-word openings over whole slices."""

    def __init__(self, templates: dict[str, str], base: dict[str, str]):
        self.automata = {**{k: compile_template(v) for k, v in base.items()}, **{k: compile_template(v) for k, v in templates.items()}}
        self.base = set(base)
        if clash := set(templates) & set(base):
            raise ValueError(f"labels used twice: {sorted(clash)}")
        self.openings = {label: self._openings(a) for label, a in self.automata.items()}
        first = {w for pairs in self.openings.values() for w, _ in pairs}
        self.hashes = {w: _hash_of(w) for w in first | {x for pairs in self.openings.values() for _, x in pairs if x}}
        self.first = np.array(sorted(self.hashes[w] for w in first), np.uint64)

    @staticmethod
    def _openings(a: Automaton) -> set[tuple[str, str | None]]:
        """The possible first two words of a match; None: any, or none."""
        out = set()
        for word, state in {x for s in a.closure({0}) for x in a.steps[s]}:
            after = a.closure({state})
            if a.last in after:
                out.add((word, None))
            out |= {(word, w) for s in after for w, _ in a.steps[s]}
        return out

    def matches(self, words: arrays.Words) -> dict[int, list[tuple[str, int, int]]]:
        """text of the slice -> (label, first word, end), words counted in the text."""
        out: dict[int, list] = {}
        if not len(words):
            return out
        hashes = arrays.word_hashes(words)
        following = np.append(hashes[1:], np.uint64(0))
        near = np.flatnonzero(np.isin(hashes, self.first))
        text_of = np.searchsorted(words.bounds, near, side="right") - 1
        for label, automaton in self.automata.items():
            hit = np.zeros(len(near), bool)
            for a, b in self.openings[label]:
                same = hashes[near] == self.hashes[a]
                hit |= same if b is None else same & (following[near] == self.hashes[b])
            for at, text in zip(near[hit].tolist(), text_of[hit].tolist()):
                begin, stop = int(words.bounds[text]), int(words.bounds[text + 1])
                ahead = _Ahead(words, at, stop)
                end = automaton.longest(ahead, 0)
                if end is not None:
                    out.setdefault(text, []).append((label, at - begin, at - begin + end))
        return out


class _Ahead:
    """The words from ``at`` on, spelled out only where they are looked at."""

    def __init__(self, words: arrays.Words, at: int, stop: int):
        self.words, self.at, self.n = words, at, stop - at

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> str:
        w = self.words
        return w.data[w.start[self.at + k]:w.end[self.at + k]].tobytes().decode()


MATCHES = "array<struct<label:string,first:long,end:long,base:boolean>>"


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, base: dict[str, str] = BASE) -> DataFrame:
    """doc_id, n_words, n_covered and ``matches`` (label, first word, end, base) of each row of ``docs``.

    n_covered counts words inside a match. Every place where a base phrase stands is a match, and the longest match
    of a template at each place where one begins. Null and empty texts have no words; repeated rows stay; an empty
    table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, base)
        kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            covered = np.zeros(batch.num_rows, np.int64)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for words in arrays.words_of(batch.column(1), WORDS):
                n_words[words.first:words.first + len(words.bounds) - 1] = np.diff(words.bounds)
                for text, places in scanner.matches(words).items():
                    places.sort(key=lambda p: (p[1], p[0]))
                    row = words.first + text
                    found[row] = [{"label": a, "first": b, "end": c, "base": a in scanner.base} for a, b, c in places]
                    reached = 0
                    for _, a, b in places:
                        covered[row] += max(0, b - max(a, reached))
                        reached = max(reached, b)
            columns = [batch.column(0), pa.array(n_words), pa.array(covered), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_covered", "matches"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return arrays.map_batches(texts, run, f"doc_id long, n_words long, n_covered long, matches {MATCHES}")


def report(scanned: DataFrame) -> DataFrame:
    """One row per document: base places and labels, all labels, and the share of words that matches cover as score."""
    base = F.filter("matches", lambda m: m.base)
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m.label))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m.first)).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m.first)).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.try_divide("n_covered", "n_words"), F.lit(0.0)).alias("score"),
    )
