"""License scans with a generalised suffix automaton of licence tokens.

All templates go into one suffix automaton over their words. A text streams through it once; the state
gives the matching statistic, the longest run ending at each word that occurs in some template. Runs
of at least ``least`` words (or a whole template, if shorter) that cannot be extended are matches.
Matches of one template that follow each other in text and template, with gaps of at most GAP words,
are chained so that the chain covers as many of its words as any can; one that covers SHARE of the
template's words gives it as a label, with its span.

Phrases are short templates with labels of their own, which are found wherever their words stand
consecutively: a phrase ends at a word if the match there is long enough and the phrase's state is
the match's state or one of its suffixes.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A to Z in lower case: digits, letters and all
characters beyond ASCII. Null and empty texts have no words, no labels and score 0. Rows may repeat.
Memory in a task is one text and the automaton, a few thousand states. Other columns stay, but for those
named like a column of the result, which the result replaces. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ._shared import small_batches, texts

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mit-named": "Released under the MIT License",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl-named": "licensed under the GNU General Public License, version 3",
    "lgpl": "GNU Lesser General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "no-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED",
}
LEAST = 4
GAP = 3
SHARE = 0.8

_WORDS = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Automaton:
    """A suffix automaton over several word lists; templates of a state are those that its strings occur in."""

    def __init__(self, templates: dict[str, list[bytes]], phrases: dict[str, list[bytes]]):
        self.ids: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [{}]
        self.size = {name: len(own) for name, own in templates.items()}
        self.phrase_sizes = [len(own) for own in phrases.values()]
        for own in [*templates.values(), *phrases.values()]:
            for w in own:
                self.ids.setdefault(w, len(self.ids))
        for name, own in templates.items():
            at = 0
            for k, w in enumerate(own, 1):
                at = self._extend(at, self.ids[w])
                self._note(at, name, k)
        for own in phrases.values():
            at = 0
            for w in own:
                at = self._extend(at, self.ids[w])
        self.phrase: list[list[tuple[str, int]]] = [[] for _ in self.go]
        where = {}
        for text, own in phrases.items():
            at = 0
            for w in own:
                at = self.go[at][self.ids[w]]
            where.setdefault(at, []).append((text, len(own)))
        for state in range(len(self.go)):
            up = state
            while up > 0:
                self.phrase[state] += where.get(up, [])
                up = self.link[up]

    def shortest(self, least: int) -> int:
        """Fewer consecutive known words than these hold neither a phrase nor a match."""
        return min([n for n in self.phrase_sizes if n] + [min(least, n) for n in self.size.values() if n], default=1)

    def _new(self, length: int, like: int | None = None) -> int:
        self.go.append({} if like is None else dict(self.go[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.length.append(length)
        self.ends.append({} if like is None else {k: list(v) for k, v in self.ends[like].items()})
        return len(self.go) - 1

    def _split(self, last: int, c: int, to: int) -> int:
        copy = self._new(self.length[last] + 1, to)
        self.link[to] = copy
        while last != -1 and self.go[last].get(c) == to:
            self.go[last][c] = copy
            last = self.link[last]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.go[last]:
            to = self.go[last][c]
            return to if self.length[to] == self.length[last] + 1 else self._split(last, c, to)
        new = self._new(self.length[last] + 1)
        while last != -1 and c not in self.go[last]:
            self.go[last][c] = new
            last = self.link[last]
        if last == -1:
            self.link[new] = 0
        else:
            to = self.go[last][c]
            self.link[new] = to if self.length[to] == self.length[last] + 1 else self._split(last, c, to)
        return new

    def _note(self, at: int, name: str, end: int) -> None:
        """The state's strings, and their suffixes, end behind word ``end`` of a template."""
        while at > 0:
            known = self.ends[at].setdefault(name, [])
            if end not in known:
                known.append(end)
            at = self.link[at]

    def stream(self, ids: list[int], first: int):
        """(end, state, length) of the longest match behind each of the known words ``ids``, from place ``first`` on."""
        state = length = 0
        for k, c in enumerate(ids, first + 1):
            while state and c not in self.go[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.go[state]:
                state, length = self.go[state][c], length + 1
            yield k, state, length


@lru_cache(4)
def automaton(templates: tuple, phrases: tuple) -> Automaton:
    return Automaton({k: words(v.encode()) for k, v in templates}, {k: words(k.encode()) for k, _ in phrases})


def chains(matches: list[tuple[int, int, str, int]], size: dict[str, int], gap: int) -> list[tuple[str, int, int, int]]:
    """(template, start, end, words covered) of the best runs of matches (start, length, template, place in it) in order.

    Of each template the chain that covers most words is taken, then the best of the matches left, and so on; a chain
    that leads to a match already taken begins behind it. Ties go to the chain that ends first.
    """
    found, own = [], {}
    for start, length, name, place in sorted(matches):
        own.setdefault(name, []).append((start, start + length, place, place + length))
    for name, spans in own.items():
        score, before, open_ = [], [], []
        for i, (start, end, place, to) in enumerate(spans):
            open_ = [j for j in open_ if start - spans[j][1] <= gap]
            best, last = end - start, -1
            for j in open_:
                _, old_end, _, old_to = spans[j]
                if end > old_end and to > old_to and place - old_to <= gap:
                    covered = score[j] + min(end - start, to - old_to, end - old_end)
                    if covered > best:
                        best, last = covered, j
            score.append(best)
            before.append(last)
            open_.append(i)
        taken = [False] * len(spans)
        for i in sorted(range(len(spans)), key=lambda k: (-score[k], spans[k][1], k)):
            at, stop = i, -1
            while at >= 0 and not taken[at]:
                taken[at], first, at = True, at, before[at]
            if at != i:
                stop = score[at] if at >= 0 else 0
                found.append((name, spans[first][0], spans[i][1], min(score[i] - stop, size[name])))
    return sorted(found, key=lambda x: (x[1], x[2], x[0]))


def scan(own: list[bytes], a: Automaton, phrases: dict[str, str], least: int, gap: int, share: float) -> tuple:
    """Phrase hits, and chains with enough cover, of one text."""
    if not own:
        return [], []
    ids = np.fromiter(map(a.ids.get, own, [-1] * len(own)), dtype=np.int32, count=len(own))
    known = np.zeros(len(own) + 2, dtype=np.int8)
    known[1:-1] = ids >= 0
    edge = np.diff(known)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= a.shortest(least)
    hits, matches = [], []
    for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        last = None
        for end, state, length in [*a.stream(ids[s:e].tolist(), s), (e + 1, 0, 0)]:
            if last and last[2] >= length:  # the match before cannot be extended
                at, was, size = last
                for name, places in a.ends[was].items():
                    if size >= min(least, a.size[name]):
                        matches += [(at - size, size, name, p - size) for p in places]
            last = (end, state, length) if state else None
            hits += [(end - size, size, text) for text, size in a.phrase[state] if length >= size]
    covered = chains(matches, a.size, gap) if matches else []
    return hits, [c for c in covered if c[3] >= share * a.size[c[0]]]


SPANS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()), T.StructField("covered", T.DoubleType())]))
COLUMNS = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def _scanner(templates: tuple, phrases: tuple, least: int, gap: int, share: float, schema):
    def run(batches):
        a, label = automaton(templates, phrases), dict(phrases)
        for batch in batches:
            rows = []
            for text in texts(batch):
                own = words(text)
                hits, found = scan(own, a, label, least, gap, share)
                base = sorted({label[t] for *_, t in hits})
                spans = [{"label": label[t], "first_word": s, "end_word": s + n, "covered": 1.0} for s, n, t in hits] + [{"label": n, "first_word": s, "end_word": e, "covered": c / a.size[n]} for n, s, e, c in found]
                places = [s for s, *_ in hits]
                rows.append({"n_words": len(own), "n_base": len(hits), "first_word": min(places, default=None), "last_word": max(places, default=None), "base_labels": ",".join(base),
                             "labels": ",".join(sorted({*base, *(n for n, *_ in found)})), "score": max((x["covered"] for x in spans), default=0.0), "spans": sorted(spans, key=lambda x: (x["first_word"], x["label"]))})
            told = pa.RecordBatch.from_pylist(rows, schema=schema)
            yield pa.record_batch([batch.column(batch.schema.get_field_index("rest")), *told.columns], names=["rest", *told.schema.names])

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, least: int = LEAST, gap: int = GAP, share: float = SHARE) -> DataFrame:
    """The other columns of ``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score and spans."""
    small_batches(docs.sparkSession)
    added = T.StructType([*T.StructType.fromDDL(COLUMNS).fields, T.StructField("spans", SPANS)])
    others = [c for c in docs.columns if c != "text"]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"), F.col("text").cast("string").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_schema

    run = _scanner(tuple(templates.items()), tuple(phrases.items()), least, gap, share, to_arrow_schema(added))
    out = held.mapInArrow(run, T.StructType([held.schema["rest"], *added.fields]))
    return out.select(*[F.col(f"rest.`{c}`") for c in others if c not in added.names], *added.names)
