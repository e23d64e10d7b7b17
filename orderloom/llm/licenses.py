"""Find licence texts in documents by matching statistics over a suffix automaton of the templates' words.

One automaton holds every stretch of words of every template and phrase; each template ends in a word of its own that no document has,
so no match runs from one into the next. A document's words stream through it: after each word the state and length say what the longest
stretch is that ends there and occurs in a template. Words that no template has reset it, so only runs of known words are walked.

A phrase's place is one whose state, or an ancestor by suffix links, is the phrase's. Stretches that can't grow to the right and have ``LONG``
words (or a whole template) are anchors at each place of a template that has them. Per template, anchors in rising order in both texts, with at most ``GAP`` other words
between them, are chained for the most covered words. A chain that covers ``SHARE`` of its template, or ``ENOUGH`` words, is a
template span, unless a span that covers more words has over half its place.

Defined results: null and empty texts have no words, empty labels, null first and last places and score 0. Texts of any length are read whole. Rows with equal or null
doc_id are documents of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.license_texts import PHRASES, TEMPLATES

LONG = 4
GAP = 12
SHARE = 0.8
ENOUGH = 24
#: Bytes that are split into words at a time.
PIECE = 1 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def words_of(text: bytes) -> Iterable[list[bytes]]:
    """Words of a text, ASCII letters in lower case, in pieces that end between words."""
    at = 0
    while at < len(text):
        gap = _BETWEEN.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = end


class Automaton:
    """Suffix automaton of several sequences of numbers; ``places[state]`` are (sequence, end) of its stretches."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        last = 0
        for s, sequence in enumerate(sequences):
            for i, word in enumerate([*sequence, -1 - s]):
                last = self._extend(last, word, ends)
                if i < len(sequence):
                    ends[last].append((s, i + 1))
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in reversed(order):
            ends[self.link[state]] += ends[state]
        self.places = ends
        self.order = order

    def _extend(self, last: int, word: int, ends: list) -> int:
        new = self._state(self.length[last] + 1, {}, -1, ends)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
            return new
        q = self.next[p][word]
        if self.length[q] != self.length[p] + 1:
            copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], ends)
            while p >= 0 and self.next[p].get(word) == q:
                self.next[p][word] = copy
                p = self.link[p]
            self.link[q] = copy
            q = copy
        self.link[new] = q
        return new

    def _state(self, length: int, following: dict, link: int, ends: list) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        ends.append([])
        return len(self.length) - 1

    def walk(self, words: Iterable[int]):
        """(state, length) after each word: the longest stretch that ends there."""
        following, link, lengths = self.next, self.link, self.length
        state = length = 0
        for word in words:
            while state and word not in following[state]:
                state = link[state]
                length = lengths[state]
            if word in following[state]:
                state = following[state][word]
                length += 1
            yield state, length


@dataclass(frozen=True)
class Span:
    label: str
    template: int
    start: int
    end: int
    template_start: int
    template_end: int
    covered: int
    share: float


class Scanner:
    def __init__(self, phrases: tuple[tuple[str, str], ...], templates: tuple[tuple[str, str], ...]):
        self.phrase_labels = [label for _, label in phrases]
        self.labels = [label for label, _ in templates]
        texts = [_WORD.findall(t.encode().lower()) for _, t in templates] + [_WORD.findall(p.encode().lower()) for p, _ in phrases]
        self.known = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        sequences = [[self.known[w] for w in t] for t in texts]
        self.sizes = [len(s) for s in sequences[:len(templates)]]
        self.automaton = a = Automaton(sequences)
        phrase_words = sequences[len(templates):]
        at = [list(a.walk(p))[-1][0] for p in phrase_words]
        # Phrases that end at a state: those of its ancestors, which are shorter than any of its stretches, and its own.
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in a.length]
        for state in a.order:
            self.phrases[state] = self.phrases[a.link[state]] + [(len(p), k) for k, (p, s) in enumerate(zip(phrase_words, at)) if s == state]
        self.least = min([LONG, *map(len, phrase_words), *self.sizes])
        self.anchors_at = [[(t, end) for t, end in places if t < len(templates)] for places in a.places]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[Span], float]:
        """Number of words, (place, phrase) in order of places, template spans, and the largest share of a template in one chain."""
        parts = [np.fromiter(map(self.known.get, words, repeat(-1)), np.int32, len(words)) for words in words_of(text)]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        found: list[tuple[int, int]] = []
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start >= self.least:
                self._run(ids[start:stop].tolist(), start, found, anchors)
        spans, most = [], 0.0
        for template, own in anchors.items():
            for start, end, t_start, t_end, covered in chains(own):
                share = covered / self.sizes[template]
                most = max(most, share)
                if share >= SHARE or covered >= ENOUGH:
                    spans.append(Span(self.labels[template], template, start, end, t_start, t_end, covered, share))
        return len(ids), sorted(found), without_lesser(spans, len(ids)), 1.0 if found else min(most, 1.0)

    def _run(self, words: list[int], start: int, found: list, anchors: dict) -> None:
        state = length = 0
        walked = self.automaton.walk(words)
        for i, (after, grown) in enumerate(walked):
            if grown != length + 1:
                self._anchor(state, length, start + i, anchors)
            state, length = after, grown
            for size, phrase in self.phrases[state]:
                if size <= length:
                    found.append((start + i + 1 - size, phrase))
        self._anchor(state, length, start + len(words), anchors)

    def _anchor(self, state: int, length: int, end: int, anchors: dict) -> None:
        for template, t_end in self.anchors_at[state] if length else ():
            if length >= min(LONG, self.sizes[template]):
                anchors.setdefault(template, []).append((end - length, t_end - length, length))


def chains(anchors: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(start, end, template start, template end, covered words) of chains of anchors (start, template start, length), most covered words
    first; chains don't overlap. A chain rises in both texts, so it has no more anchors than the template has words."""
    anchors = sorted(set(anchors))
    reach = GAP + max(n for _, _, n in anchors)
    best: list[tuple[int, int]] = []  # most covered words of a chain that ends in an anchor, and the anchor before
    for i, (at, t_at, n) in enumerate(anchors):
        own = (n, -1)
        for j in range(i - 1, -1, -1):
            before, t_before, m = anchors[j]
            if at - before > reach:
                break
            overlap = max(0, before + m - at, t_before + m - t_at)
            if before < at and t_before < t_at and overlap < n and at - (before + m) <= GAP:
                own = max(own, (best[j][0] + n - overlap, j))
        best.append(own)
    out, used, taken = [], set(), []
    for i in sorted(range(len(anchors)), key=lambda i: (-best[i][0], i)):
        line = [i]
        while best[line[-1]][1] >= 0:
            line.append(best[line[-1]][1])
        fresh = used.isdisjoint(line)
        used.update(line)
        first, last = anchors[line[-1]], anchors[i]
        start, end = first[0], last[0] + last[2]
        place = bisect.bisect_left(taken, (start, end))
        if fresh and (not place or taken[place - 1][1] <= start) and (place == len(taken) or taken[place][0] >= end):
            taken.insert(place, (start, end))
            out.append((start, end, first[1], last[1] + last[2], best[i][0]))
    return out


def without_lesser(spans: list[Span], n_words: int) -> list[Span]:
    """Spans by place, without those that have over half their place under spans with more covered words."""
    taken, kept = np.zeros(n_words, bool), []
    for span in sorted(spans, key=lambda s: (-s.covered, -s.share, s.start, s.template)):
        if 2 * taken[span.start:span.end].sum() <= span.end - span.start:
            taken[span.start:span.end] = True
            kept.append(span)
    return sorted(kept, key=lambda s: (s.start, s.end, s.template))


@lru_cache(maxsize=4)
def scanner(phrases: tuple[tuple[str, str], ...], templates: tuple[tuple[str, str], ...]) -> Scanner:
    """The worker's own scanner, which it keeps from task to task."""
    return Scanner(phrases, templates)


SPAN = T.StructType([T.StructField("label", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in (
    "template", "start", "end", "template_start", "template_end", "covered")), T.StructField("share", T.DoubleType())])
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(SPAN))])


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_words, n_base (places of phrases), first_word and last_word (their smallest and largest start), base_labels, labels,
    score (1 with a phrase, else the largest share of a template that one chain covers) and spans (words from ``start`` to before ``end``)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, wanted = to_arrow_schema(FOUND), (tuple(phrases.items()), tuple(tuple(t) for t in templates))

    def scanned(batches):
        scan = scanner(*wanted)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n_words, base, spans, score = scan.scan(text.as_py() or b"")
                base_labels = {scan.phrase_labels[k] for _, k in base}
                rows.append((doc_id, n_words, len(base), base[0][0] if base else None, base[-1][0] if base else None,
                             ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {s.label for s in spans})), score,
                             [asdict(s) for s in spans]))
            columns = zip(*rows) if rows else ((),) * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(scanned, FOUND)
