"""SimHash groups, repeated bytes, repeated words and components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from orderloom.llm import debruijn, sequences, simhash, suffix_array
from orderloom.llm.components import components
from orderloom.llm.workspace import Workspace
from tests.llm.conftest import make, rows, words


def find_roots(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = components(Workspace(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    assert {r["node"]: r["root"] for r in got} == {n: r for n, r in find_roots(nodes, edges).items()}


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint(odd_pairs):
    for _, t in odd_pairs:
        assert simhash.fingerprint(None if t is None else t.encode()) == plain_fingerprint(t)


@pytest.mark.parametrize("crowd", [0, 2, 64])
def test_links_join_all_within_two_bits(spark, crowd):
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.randrange(64)
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(Workspace(spark, "t"), df, crowd).collect()]
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    assert find_roots(signed, edges) == find_roots(signed, near)
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 for a, b in edges)


@pytest.mark.parametrize("crowd", [0, 64])
def test_near_duplicates(odd, odd_pairs, crowd):
    fps = [(i, plain_fingerprint(t)) for i, t in odd_pairs]
    distinct = sorted({f for _, f in fps})
    root = find_roots(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if bin(a ^ b).count("1") <= 2])
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in fps), key=repr)
    assert rows(simhash.near_duplicates(odd, crowd=crowd), "doc_id", "fingerprint", "component_id") == want


def test_one_of_each(odd, empty):
    got = rows(simhash.one_of_each(odd), "doc_id", "text")
    groups = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()}
    assert simhash.one_of_each(odd).columns == odd.columns
    assert [i for i, _ in got] == sorted((i for i, c in groups if i is not None and i == c), key=lambda i: repr((i,)))
    assert simhash.one_of_each(empty).count() == simhash.near_duplicates(empty).count() == 0


def plain_bytes(pairs, width):
    texts = [(t or "").encode() for _, t in pairs]
    seen = Counter(b[i:i + width] for b in texts for i in range(len(b) - width + 1))
    out = []
    for (doc_id, _), b in zip(pairs, texts):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc_id, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("width, k, crowd", [(400, 64, 1024), (60, 16, 0), (40, 40, 1), (30, 5, 1024)])
def test_suffix_dedup(odd, odd_pairs, width, k, crowd):
    assert rows(suffix_array.suffix_dedup(odd, width, k, crowd), *BYTES) == plain_bytes(odd_pairs, width)


@pytest.mark.parametrize("passage, passage_k, crowd", [(60, 16, 1024), (150, 32, 2), (199, 20, 64)])
def test_passages_are_reported_and_longer_repeats_removed(spark, odd, odd_pairs, passage, passage_k, crowd):
    """Both lengths against brute force, the longer one searched in stretches of the shorter one only."""
    rng = random.Random(19)
    shared = [words(rng, n) for n in (12, 25, 45, 60, 90)]
    pairs = [(i, " ".join([words(rng, rng.randrange(20)), *rng.sample(shared, 2), words(rng, 5)])) for i in range(40)] + [(3, None), (None, shared[3] * 2)]
    for df, texts in ((make(spark, pairs), pairs), (odd, odd_pairs)):
        got = suffix_array.suffix_dedup(df, 200, 32, crowd, passage, passage_k)
        assert rows(got, *BYTES) == plain_bytes(texts, 200)
        assert rows(got, "doc_id", "n_bytes", "n_passages") == sorted(((r[0], r[1], r[3]) for r in plain_bytes(texts, passage)), key=repr)


def test_suffix_dedup_shared_passage(spark):
    """A passage in many documents, each with other text around it, and near copies."""
    rng = random.Random(9)
    passage, base = words(rng, 100), words(rng, 150)
    pairs = [(i, words(rng, rng.randrange(0, 30)) + " " + passage[rng.randrange(5):] + words(rng, 20)) for i in range(60)]
    for i in range(60):
        t = base.split()
        t[rng.randrange(len(t))] = f"x{i}"
        pairs.append((100 + i, " ".join(t)))
    df = make(spark, pairs)
    for crowd in (8, 1024):
        assert rows(suffix_array.suffix_dedup(df, 200, 32, crowd), *BYTES) == plain_bytes(pairs, 200)
    assert rows(debruijn.substring_dedup(df, 20, 6), *WORDS) == plain_words(pairs, 20)


def test_cut_texts(odd, odd_pairs, empty):
    got = suffix_array.without_repeats(odd)
    assert got.columns == odd.columns and got.count() == len(odd_pairs)
    digest = {(r[0], r[4]) for r in plain_bytes(odd_pairs, 400)}
    for r in got.collect():
        if r["doc_id"] != 12:  # its two-byte characters may be cut
            assert (r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) in digest
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    assert suffix_array.without_repeats(empty).count() == suffix_array.suffix_dedup(empty).count() == 0


def plain_words(pairs, width):
    first = {}
    for i, t in pairs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for j in range(len(w) - width + 1):
            if i is not None:
                first[tuple(w[j:j + width])] = min(i, first.get(tuple(w[j:j + width]), i))
    out = []
    for i, t in pairs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if i is not None and first[tuple(w[j:j + width])] < i:
                gone[j:j + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("width, k", [(50, 16), (10, 4), (6, 6)])
def test_substring_dedup(odd, odd_pairs, width, k):
    assert rows(debruijn.substring_dedup(odd, width, k), *WORDS) == plain_words(odd_pairs, width)


def test_substring_dedup_of_nothing(empty):
    assert debruijn.substring_dedup(empty).count() == 0


def test_runs_cover_each_window_once():
    rng = np.random.default_rng(1)
    values = sequences.byte_values()
    seqs = [rng.integers(0, 4, rng.integers(0, 60)).astype(np.uint8) for _ in range(40)]
    for width, k in ((10, 4), (7, 7), (12, 3)):
        cover = [np.zeros(max(0, len(s) - width + 1), int) for s in seqs]
        place = {}
        for r in sequences.all_runs([values[s] for s in seqs], width, k):
            for d, start, n, off, key in zip(*(r[c] for c in ("doc", "start", "n", "off", "key"))):
                cover[d][start:start + n] += 1
                for i in range(n):
                    place.setdefault(seqs[d][start + i:start + i + width].tobytes(), set()).add((key, off - i))
        assert all((c == 1).all() for c in cover)
        assert max(map(len, place.values())) == 1


def test_long_sequences_are_cut(monkeypatch):
    monkeypatch.setattr(sequences, "CHUNK", 64)
    rng = np.random.default_rng(2)
    s = rng.integers(0, 3, 500).astype(np.uint8)
    cover = np.zeros(len(s) - 19, int)
    for r in sequences.all_runs([sequences.byte_values()[s]], 20, 5):
        for start, n in zip(r["start"], r["n"]):
            cover[start:start + n] += 1
    assert (cover == 1).all()
    text = b"a bb  ccc\n d " * 20
    assert len(sequences.word_values(text)) == len(text.split())


def test_two_stage_order():
    rng = np.random.default_rng(5)
    for _ in range(100):
        depth, letters = int(rng.integers(2, 9)), int(rng.integers(1, 4))
        texts = [bytes(rng.integers(0, letters, rng.integers(1, 40)).astype(np.uint8) + 97) for _ in range(rng.integers(1, 8))]
        text = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.uint16) + 1, 0) for t in texts]).astype(np.uint16)
        order = suffix_array.two_stage_order(text, np.ones(len(text), bool), suffix_array.Prefixes(text, depth))
        ends = [int(np.flatnonzero(text[i:] == 0)[0]) + i for i in order]
        prefixes = [tuple(text[i:min(e, i + depth)].tolist()) for i, e in zip(order, ends)]
        assert prefixes == sorted(prefixes) and sorted(order.tolist()) == list(range(len(text)))
