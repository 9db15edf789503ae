"""License scan by template markup compiled into token automata.

A template is plain wording with two kinds of markup:

``<<beginOptional>> ... <<endOptional>>``  wording that may be absent (may nest)
``<<var;name=NAME;words=LO..HI>>``         replaceable region of LO to HI words

Everything else is mandatory and has to match word for word. A template
compiles to a nondeterministic automaton over words whose subset states are
built on demand; a text matches where the automaton, started at some word,
reaches its final state.

Defined results: a null, empty or word-free text has no words and no match;
repeated rows give repeated results; very long texts are scanned whole in one
pass; other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, in_parts, utf8

# Phrases of the base rule and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public license notices.
TEMPLATES = {
    "mit-notice": "<<beginOptional>>this <<var;name=work;words=1..3>> is<<endOptional>> "
                  "<<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> "
                  "under the <<beginOptional>>terms of the<<endOptional>> MIT license",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                "<<var;name=software;words=1..12>>, to deal in the software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, "
                "distribute, sublicense, and/or sell copies of the software",
    "apache-2.0-notice": "licensed under the Apache License, Version 2.0 "
                         "<<beginOptional>>the license<<endOptional>>",
    "gpl-3.0-notice": "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU "
                      "<<beginOptional>>lesser<<endOptional>> General Public License, "
                      "<<beginOptional>>as published by the free software foundation, either"
                      "<<endOptional>> version 3",
    "gpl-text": "<<beginOptional>>this program<<endOptional>> is free software: you can redistribute it and/or "
                "modify it under the terms of the GNU <<beginOptional>>lesser<<endOptional>> general "
                "public license as published by the free software foundation",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, "
                "are permitted provided that the following conditions are met",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose "
                "with or without fee is hereby granted, provided that "
                "<<var;name=notices;words=1..16>> appear in all copies",
    "cc-by-notice": "licensed under a Creative Commons Attribution "
                    "<<beginOptional>><<var;name=kind;words=1..3>><<endOptional>> "
                    "<<var;name=version;words=2..2>> <<var;name=port;words=1..2>> license",
}

# Lower-cases A-Z and turns every other ASCII byte but digits and a-z into a space;
# bytes of other characters stay, as all of those belong to words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(_WORD_BYTES).split()


@dataclass
class TokenAutomaton:
    """Automaton over words. ``edges[s]`` maps a word (None: any word) to states,
    ``skips[s]`` lists states reached without a word; 0 is the start."""
    edges: list[dict] = field(default_factory=lambda: [{}])
    skips: list[set] = field(default_factory=lambda: [set()])
    final: int = 0
    _memo: dict = field(default_factory=dict)

    def state(self) -> int:
        self.edges.append({})
        self.skips.append(set())
        return len(self.edges) - 1

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        out = set()
        for s in states:
            e = self.edges[s]
            out.update(e.get(word, ()))
            out.update(e.get(None, ()))
        return self.closure(out)

    def start(self) -> frozenset:
        if "start" not in self._memo:
            self._memo["start"] = self.closure({0})
        return self._memo["start"]

    def match_at(self, words: list[bytes], i: int) -> int | None:
        """End (exclusive) of the shortest match that starts at word ``i``."""
        states = self.start()
        while True:
            if self.final in states:
                return i
            if not states or i >= len(words):
                return None
            states = self.step(states, words[i])
            i += 1

    def openings(self, n: int = 3) -> set[tuple]:
        """Every way a match can begin: up to ``n`` words, shorter where a
        replaceable word or the end comes earlier."""
        out, todo = set(), [((), self.start())]
        while todo:
            head, states = todo.pop()
            if len(head) == n or self.final in states or any(None in self.edges[s] for s in states):
                out.add(head)
                continue
            for w in {w for s in states for w in self.edges[s]}:
                todo.append((head + (w,), self.step(states, w)))
        return out


_MARK = re.compile(r"<<(beginOptional|endOptional|var;name=[^;>]*;words=(\d+)\.\.(\d+))>>")


def compile_template(template: str) -> TokenAutomaton:
    """Compile template markup; unbalanced optional marks are an error."""
    a, at, opened, cut = TokenAutomaton(), 0, [], 0

    def wording(at: int, text: str) -> int:
        for w in words_of(text.encode()):
            nxt = a.state()
            a.edges[at].setdefault(w, set()).add(nxt)
            at = nxt
        return at

    for m in _MARK.finditer(template):
        at, cut = wording(at, template[cut:m.start()]), m.end()
        if m[1] == "beginOptional":
            nxt = a.state()                 # own entry state: nothing loops back into it
            a.skips[at].add(nxt)
            opened.append(at)
            at = nxt
        elif m[1] == "endOptional":
            if not opened:
                raise ValueError("endOptional without beginOptional")
            nxt = a.state()
            a.skips[at].add(nxt)
            a.skips[opened.pop()].add(nxt)
            at = nxt
        else:
            lo, hi = int(m[2]), int(m[3])
            end = a.state()
            for k in range(hi + 1):
                if k >= lo:
                    a.skips[at].add(end)
                if k < hi:
                    nxt = a.state()
                    a.edges[at].setdefault(None, set()).add(nxt)
                    at = nxt
            at = end
    if opened:
        raise ValueError("beginOptional without endOptional")
    a.final = wording(at, template[cut:])
    return a


class LicenseScanner:
    """Base phrases and compiled templates, applied to one text at a time."""

    def __init__(self, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES):
        self.phrases = [(b" " + b" ".join(words_of(p.encode())) + b" ", label) for p, label in phrases.items()]
        self.automata = []
        for label, t in templates.items():
            a = compile_template(t)
            # A template that opens with a replaceable region is tried at every word; all
            # others only where one of their openings stands.
            openings = a.openings()
            needles = None if () in openings else [b" " + b" ".join(o) + b" " for o in openings]
            self.automata.append((label, a, needles))

    @staticmethod
    def _starts(line: bytes, needle: bytes):
        """Word positions at which ``needle`` (blank, words, blank) stands in ``line``."""
        at, word, seen = line.find(needle), -1, 0
        while at >= 0:
            word += line.count(b" ", seen, at + 1)
            seen = at + 1
            yield word
            at = line.find(needle, at + 1)

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for needle, label in self.phrases:
            found = list(self._starts(line, needle))
            places += found
            if found:
                base.add(label)
        spans = []
        for label, a, needles in self.automata:
            starts = (range(len(words)) if needles is None
                      else (i for needle in needles for i in self._starts(line, needle)))
            for i in starts:
                end = a.match_at(words, i)
                if end is not None:
                    spans.append((i, end, label))
        spans = sorted(set(spans))
        own = {label for _, _, label in spans}
        return {"n_words": len(words), "n_base": len(places),
                "first_word": min(places, default=None), "last_word": max(places, default=None),
                "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | own)),
                "score": 1.0 if own else 0.5 if base else 0.0,
                "spans": [{"first": i, "end": j, "label": label} for i, j, label in spans]}


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans array<struct<first: long, end: long, label: string>>")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: words, base phrase places, labels and the matched
    template spans (word positions). ``score`` is 1.0 with a template match, 0.5
    with base phrases alone, else 0.0. A narrow map over whole texts: no shuffle."""
    phrases, templates = dict(phrases), dict(templates)
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                        ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                        ("labels", pa.string()), ("score", pa.float64()), ("spans", span)])

    def scan(batches):
        scanner = LicenseScanner(phrases, templates)
        for batch in batches:
            for part in in_parts(batch, "text"):
                rows = [{"doc_id": d, **scanner.scan(t)}
                        for d, t in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")))]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(scan, SCHEMA)
