"""Licence scans: matching statistics against a suffix automaton of licence words, chained into covered spans."""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import text as tx

# Phrases that name a licence, and well-known wordings of grants and notices.
PHRASES = {"the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache-2-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "apache-2-line": "licensed under the apache license version 2 0",
    "bsd-conditions": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "mit-line": "released under the mit license",
    "cc-by-line": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-line": "licensed under cc by nc 4 0",
}


@dataclass(frozen=True)
class LicenseScan:
    """A match of ``least`` words or more takes part in chains; matches chain over at most ``gap`` words; a chain that covers
    ``cover`` of a template gives its label."""

    phrases: tuple[tuple[str, str], ...] = tuple(PHRASES.items())
    templates: tuple[tuple[str, str], ...] = tuple((t, name) for name, t in TEMPLATES.items())
    least: int = 3
    gap: int = 12
    cover: float = 0.7


class SuffixAutomaton:
    """All substrings of several token sequences. ``places[s]`` are the (sequence, last position) of state s's strings."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.length, self.places = [{}], [-1], [0], [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for position, token in enumerate(sequence):
                last = self._add(last, token)
                self.places[last].add((number, position))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.places[self.link[state]] |= self.places[state]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.places.append(set())
        return len(self.link) - 1

    def _add(self, last: int, token: int) -> int:
        following = self.next[last].get(token)
        if following is not None and self.length[following] == self.length[last] + 1:
            return following
        if following is not None:
            return self._split(last, token, following)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            old = self.next[state][token]
            self.link[new] = old if self.length[old] == self.length[state] + 1 else self._split(state, token, old)
        return new

    def _split(self, state: int, token: int, old: int) -> int:
        half = self._state(self.length[state] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = half
        while state >= 0 and self.next[state].get(token) == old:
            self.next[state][token] = half
            state = self.link[state]
        return half

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """For every position the length of the longest match that ends there, and its state."""
        state, length = 0, 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            else:
                length = 0
            yield length, state


def scan(documents: DataFrame, spec: LicenseScan = LicenseScan(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, places array<(label, start, length)>, spans array<(label, start, end, share)>.

    Words are runs of letters, digits and all non-ASCII characters, A-Z as a-z. ``places`` are all places of the phrases,
    overlapping ones too, whatever their length; ``spans`` the chains of matches that cover enough of a template, as words
    [start, end) and the covered share: of chains of one template that overlap, the best. Equal chains: the earlier
    one. Texts of any length are streamed as a whole. Words that no template has break a match, so only runs of known words are streamed
    through the automaton. Null and empty texts have no words; repeated rows and null ids have their rows.
    """
    names = [label for _, label in (*spec.phrases, *spec.templates)]
    texts = [t.split() for t, _ in (*spec.phrases, *spec.templates)]
    vocabulary = sorted({w for t in texts for w in t})
    number = {w: i for i, w in enumerate(vocabulary)}
    tokens = [[number[w] for w in t] for t in texts]
    automaton = SuffixAutomaton(tokens)
    n_phrases = len(spec.phrases)
    shortest = min([len(t) for t in tokens[:n_phrases]] + [spec.least])
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()),
            ("places", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))),
            ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))),
        ]
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, offsets = tx.buffer(pa.array(vocabulary))
        starts, ends, _ = tx.words(raw, offsets, tx.ALNUM)
        known = tx.word_hashes(raw, starts, ends)
        order = np.argsort(known)
        gate = np.zeros(1 << 16, dtype=bool)
        gate[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in tx.slices(batches, "text"):
            raw, offsets = tx.buffer(batch.column(1))
            starts, ends, bounds = tx.words(raw, offsets, tx.ALNUM)
            hashes = tx.word_hashes(raw, starts, ends)
            ids = np.full(len(hashes), -1, dtype=np.int64)
            maybe = np.flatnonzero(gate[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known[order], hashes[maybe]), len(known) - 1)
            hit = known[order][place] == hashes[maybe]
            ids[maybe[hit]] = order[place[hit]]
            # Runs of known words inside one text.
            inside = ids >= 0
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = bounds[1:-1]
            first[edges[edges < len(ids)]] = inside[edges[edges < len(ids)]]
            last[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
            begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            long_enough = end - begin >= shortest
            begin, end = begin[long_enough], end[long_enough]
            owner = np.searchsorted(bounds, begin, side="right") - 1
            places, matches = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for row, a, b in zip(owner.tolist(), begin.tolist(), end.tolist()):
                _stream(automaton, ids[a:b].tolist(), a - int(bounds[row]), tokens, n_phrases, spec.least, names, places[row], matches[row])
            spans = [_chains(m, tokens, n_phrases, names, spec) if m else [] for m in matches]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), pa.array(places, schema.field(2).type), pa.array(spans, schema.field(3).type)], schema=schema)

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(of, "doc_id long, n_words long, places array<struct<label:string,start:long,length:long>>, spans array<struct<label:string,start:long,end:long,share:double>>")


def _stream(automaton: SuffixAutomaton, ids: list[int], at: int, tokens: list, n_phrases: int, least: int, names: list[str], places: list, matches: list) -> None:
    """Collects one run's phrase places and its matches of templates, each where it can't be made longer to the right along its own template."""
    shortest = min([len(t) for t in tokens[:n_phrases]] + [least])
    for i, (length, state) in enumerate(automaton.statistics(ids)):
        if length < shortest:
            continue
        following = ids[i + 1] if i + 1 < len(ids) else -1
        # All suffixes of the match are in the places of the state and of the states its links lead to.
        seen = set()
        while state > 0:
            for number, position in automaton.places[state]:
                if (number, position) in seen:
                    continue
                seen.add((number, position))
                size = len(tokens[number])
                reach = min(length, position + 1)
                if number < n_phrases:
                    if position == size - 1 and reach >= size:
                        places.append({"label": names[number], "start": at + i - size + 1, "length": size})
                elif reach >= least and (position + 1 == size or tokens[number][position + 1] != following):
                    matches.append((number, at + i + 1, position + 1, reach))
            length, state = automaton.length[automaton.link[state]], automaton.link[state]
            if length < shortest:
                break


def _chains(matches: list, tokens: list, n_phrases: int, names: list[str], spec: LicenseScan) -> list:
    """For each template the chains of matches, in order in text and template, that cover enough of its words.

    The best chain is found up to each match. The best of all stands; then the next best that overlaps none that stand.
    """
    out = []
    for number in range(n_phrases, len(tokens)):
        own = sorted((end, stop, size) for n, end, stop, size in matches if n == number)
        best: list[tuple[int, int]] = []
        for i, (end, stop, size) in enumerate(own):
            top = (size, end - size)
            for j in range(i - 1, -1, -1):
                before_end, before_stop, _ = own[j]
                # Matches are at most a template long, so those that end further back can't be within the gap.
                if end - before_end > spec.gap + len(tokens[number]):
                    break
                new = min(size, end - before_end, stop - before_stop)
                if new > 0 and end - new - before_end <= spec.gap and best[j][0] + new > top[0]:
                    top = (best[j][0] + new, best[j][1])
            best.append(top)
        enough = [(-cover, own[i][0], start) for i, (cover, start) in enumerate(best) if min(1.0, cover / len(tokens[number])) >= spec.cover]
        starts, ends = [], []  # of the spans that stand, in order
        for cover, end, start in sorted(enough):
            at = bisect.bisect_left(ends, start + 1)
            if at < len(starts) and starts[at] < end:
                continue
            starts.insert(at, start)
            ends.insert(at, end)
            out.append({"label": names[number], "start": start, "end": end, "share": min(1.0, -cover / len(tokens[number]))})
    return sorted(out, key=lambda s: (s["start"], s["end"], s["label"]))


def digest(found: DataFrame) -> DataFrame:
    """Counts and labels of a scan: n_base, first_word, last_word, base_labels, labels, score (1 for a phrase, else the best share)."""
    base = F.transform("places", lambda p: p.label)
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p.start)).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p.start)).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("spans", lambda s: s.label))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: s.share)), F.lit(0.0))).alias("score"),
    )
