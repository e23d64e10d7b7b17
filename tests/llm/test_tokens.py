"""Token planes, packing, sharding and token counts against direct computation."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from orderloom.llm import packing, sharding, token_count, token_planes
from orderloom.llm.encoding import Encoder
from orderloom.llm.queries import tokenizer_path
from tests.llm.conftest import make, rows


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_encoder_equals_library(direct):
    texts = ["", " ", "a  b", "a\n b ", " x", "\n\n a\t b", "<|endoftext|> x", "a  b", "a \x1c b", "　q 12 34's", "don't  we'll  ",
             "a b.\nC d", "x y.\n\nZ w", "x y's.\nA b²c, d²", "éé ñu 漢字 ab漢", "x ́a. b́.", None, "ＡＢ ｃｄ"]
    for size in (3, 1000):
        e = Encoder(tokenizer_path(), size)
        for _ in range(2):
            assert [np.frombuffer(i, "<u4").tolist() + [2] for i in e.encode(texts)] == [direct(t).tolist() for t in texts]


def test_encoder_cuts_plain_pieces(direct):
    """Pieces of plain letters, digits and marks never go to the whole library, and random characters give its ids."""
    e, asked = Encoder(tokenizer_path()), []
    library = e._encode
    e._encode = lambda texts: asked.extend(texts) or library(texts)
    texts = ["One, (two).\nThree!! don't we'll'sx 42nd x_y é. ÀÉ###", "\nЖук, one\n\n", "two, one. x\n\nThree 4,000"]
    assert [np.frombuffer(i, "<u4").tolist() + [2] for i in e.encode(texts)] == [direct(t).tolist() for t in texts]
    assert not asked
    rng = random.Random(4)
    texts = ["".join(rng.choice("aZsé\u0174\u0416\u04829.,''#\n\t    \u00bd\u00b7\u00aa\u00a0\u0301\u6f22") for _ in range(rng.randrange(40))) for _ in range(800)]
    for size in (20, 600_000):
        e = Encoder(tokenizer_path(), size)
        for _ in range(2):
            assert [np.frombuffer(i, "<u4").tolist() + [2] for i in e.encode(texts)] == [direct(t).tolist() for t in texts]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 32, n, np.uint64).astype("<u4")
        assert (token_planes.from_planes(token_planes.to_planes(ids, kind), n, kind) == ids).all()


def test_crc32_join():
    for a, b in ((b"", b"x"), (b"abc", b""), (b"abc" * 99, bytes(range(256)) * 50)):
        assert token_planes.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("block, kind", [(64, "bit"), (1 << 16, "byte")])
def test_token_files(odd, odd_pairs, direct, block, kind):
    path, digest = token_planes.encode_documents(odd, tokenizer_path(), block, kind)
    got = sorted(digest.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in odd_pairs), key=lambda i: (i is not None, i or 0))
    want = Counter((i, len(ids := direct(t)), zlib.crc32(ids.tobytes())) for i, t in odd_pairs)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in got])[:-1])).tolist()
    pieces = sorted(token_planes.read_segments(odd.sparkSession, path).collect(), key=lambda r: (r["part"], r["first"]))
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces])
    assert len(ids) == got[-1]["start"] + got[-1]["n_tokens"]


def test_token_files_of_nothing(empty):
    assert token_planes.encode_documents(empty, tokenizer_path())[1].count() == 0


def checked_plan(histogram, capacity):
    runs, sequences, fixed = packing.plan_packing(dict(histogram), capacity)
    bins, seen = {}, Counter()
    for r in runs:
        for q in range(r.bins * r.each):
            bins.setdefault(r.sequence + q // r.each, []).append((r.offset + q % r.each * r.length, r.length))
            seen[r.length, r.rank + q] += 1
    assert seen == Counter({(n, i): 1 for n, c in histogram.items() for i in range(c)})
    assert sorted(bins) == list(range(sequences))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences, fixed


def fewest(lengths, capacity):
    """By trying all ways."""
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[j] >= lengths[i]:
                go(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1:]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best[0]


def floor_of(histogram, capacity):
    """No packing needs fewer: pieces over half the capacity are apart, and what is shorter has the room beside some of them."""
    best = -(-sum(n * c for n, c in histogram.items()) // capacity)
    for short in range(capacity // 2 + 1):
        large = sum(c for n, c in histogram.items() if n > capacity - short)
        middle = [(n, c) for n, c in histogram.items() if capacity - short >= n > capacity / 2]
        beside = sum((capacity - n) * c for n, c in middle)
        rest = sum(n * c for n, c in histogram.items() if capacity / 2 >= n >= short)
        best = max(best, large + sum(c for _, c in middle) + max(0, -(-(rest - beside) // capacity)))
    return best


def test_plan_is_whole_and_near_the_best():
    rng = random.Random(3)
    extra = 0
    for _ in range(150):
        lengths = sorted((rng.randrange(1, 21) for _ in range(rng.randrange(1, 11))), reverse=True)
        got, _ = checked_plan(Counter(lengths), 20)
        best = fewest(lengths, 20)
        assert best <= got <= best + 1
        extra += got - best
    assert extra <= 8
    for _ in range(20):
        histogram = {n: rng.randrange(0, 50) for n in rng.sample(range(1, 101), 30)}
        got, _ = checked_plan(histogram, 100)
        assert floor_of(histogram, 100) <= got <= 1.03 * floor_of(histogram, 100)


def test_reduction_keeps_the_best_reachable():
    """What is fixed never costs a sequence: the rest packed by trying all ways gives the fewest."""
    rng = random.Random(4)
    for _ in range(150):
        lengths = [rng.randrange(3, 21) for _ in range(rng.randrange(1, 9))]
        plan = packing._Plan(Counter(lengths), 20)
        fixed = plan.reduce()
        rest = sorted((n for n, c in plan.left.items() for _ in range(c)), reverse=True)
        assert fixed + fewest(rest, 20) == fewest(sorted(lengths, reverse=True), 20)


def test_packed_documents(odd, odd_pairs, direct):
    got = packing.pack_documents(odd, tokenizer_path(), 128).collect()
    texts = {}
    for i, t in odd_pairs:
        texts.setdefault(i, []).append(direct(t))
    for r in got:
        assert any(zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for ids in texts[r["doc_id"]])
        assert 1 <= r["length"] <= 128
    assert sum(r["length"] for r in got) == sum(len(ids) for all_ in texts.values() for ids in all_)
    assert len(got) == sum(-(-len(ids) // 128) for all_ in texts.values() for ids in all_)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 128
    assert len(by) <= 1.02 * sum(r["length"] for r in got) / 128 + 2


def test_packing_nothing(empty):
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_permutation_is_one_and_seeded(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 7, 100, 997):
        ids = spark.range(n)
        a, b = ([r[0] for r in ids.select(sharding.permuted(F.col("id"), n, seed)).collect()] for seed in (0, 1))
        assert sorted(a) == sorted(b) == list(range(n))
        assert n < 50 or (a != b and a != list(range(n)))


def test_shards(odd, odd_pairs, empty):
    got = sharding.shard_documents(odd).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_pairs)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_documents(empty).count() == 0


def test_row_numbers_from_shards_and_slots(spark):
    from pyspark.sql import functions as F
    for n, shards in ((1, 3), (2, 8), (7, 2), (10, 4), (97, 8), (1000, 7)):
        ids = spark.range(n)
        place = sharding.permuted(F.col("id"), n, 5)
        dealt = ids.select("id", (place % shards).alias("shard"), F.floor(place / shards).cast("long").alias("slot"))
        back = dealt.select("id", sharding.row_number_at(F.col("shard"), F.col("slot"), n, shards, 5).alias("row"))
        assert back.where("id <> row").count() == 0 and back.count() == n


def best_split(word, pieces, fallback):
    """(score, -tokens) by trying every end."""
    table = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        ways = [(table[end - 1][0] + fallback * size, table[end - 1][1] - size)]
        ways += [(table[s][0] + pieces[word[s:end]], table[s][1] - 1) for s in range(end) if word[s:end] in pieces]
        table.append(max(ways))
    return -table[-1][1]


def test_token_counts(odd, odd_pairs, empty):
    model = tokenizer_path("piece_bpe_32k.model")
    short = odd.where("text IS NULL OR length(text) < 5000")
    pieces = token_count.fitted(Counter(w for _, t in odd_pairs if len(t or "") < 5000 for w in (t or "").split()), token_count.load_pieces(model))
    counter = token_count.TrieCounter(pieces)
    want = sorted(((i, len(w := (t or "").split()), sum(best_split("▁" + x, pieces, counter.fallback) for x in w))
                   for i, t in odd_pairs if len(t or "") < 5000), key=repr)
    assert rows(token_count.token_counts(short, model), "doc_id", "n_pretokens", "n_tokens") == want
    assert token_count.token_counts(empty, model).count() == 0


def test_bounded_piece_table_changes_nothing():
    pieces = token_count.load_pieces(tokenizer_path("piece_bpe_32k.model"))
    texts = ["some words here", "other words there", None, "zz §§ 漢字"] * 3
    assert token_count.TrieCounter(pieces, 2).counts(texts) == token_count.TrieCounter(pieces).counts(texts)


def test_sampled_pretokens_are_counted_over_all_documents(spark, odd, odd_pairs, empty):
    every = Counter(w for _, t in odd_pairs for w in (t or "").split())
    for size in (1, 7, 100, 10 ** 6):
        least = sorted(every, key=lambda w: (token_count._hash(w), w))[:size]
        for df in (odd, odd.repartition(1), odd.repartition(9)):
            assert token_count.sampled_pretokens(df, size) == {w: every[w] for w in least}
    assert token_count.sampled_pretokens(empty) == {}


def test_probabilities_come_from_every_pretoken(spark):
    """More different pre-tokens than any sample had: each counts in the fit, and improbable words as well."""
    texts = [" ".join(f"q{i:x}z" for i in range(a, a + 500)) for a in range(0, 21_000, 500)] + ["é" * 400, None, "§§ the the re"]
    pieces = {p: -float(i) for i, p in enumerate([token_count.WORD_START, "q", "z", "the", "re", *"0123456789abcdef", "é", token_count.WORD_START + "the"], 1)}
    want = token_count.fitted(Counter(w for t in texts for w in (t or "").split()), pieces)
    words = token_count.pretoken_counts(make(spark, list(enumerate(texts))).repartition(5)).cache()
    assert words.count() == 21_004
    got = token_count.fitted_to(words, pieces)
    assert got == pytest.approx(want) and got != pytest.approx(pieces)
    assert token_count.fitted_to(words.limit(0), pieces) == pieces


def splits(word, pieces, fallback):
    """Every segmentation: (its log-probability, its pieces)."""
    if not word:
        yield 0.0, []
        return
    for rest in splits(word[1:], pieces, fallback):
        yield rest[0] + fallback * len(word[0].encode()), rest[1]
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for score, used in splits(word[n:], pieces, fallback):
                yield score + pieces[word[:n]], [word[:n], *used]


def test_expected_uses_against_all_segmentations():
    rng = random.Random(14)
    for _ in range(20):
        pieces = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 4))): -rng.random() * 3 for _ in range(8)}
        words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 8))): rng.randrange(1, 5) for _ in range(10)}
        got, total = token_count.expected_uses(words, pieces, -4.0)
        want, likelihood = dict.fromkeys(pieces, 0.0), 0.0
        for word, n in words.items():
            ways = list(splits(word, pieces, -4.0))
            mass = sum(math.exp(s) for s, _ in ways)
            likelihood += n * math.log(mass)
            for s, used in ways:
                for p in used:
                    want[p] += n * math.exp(s) / mass
        assert got == pytest.approx(want) and total == pytest.approx(likelihood)


def test_one_pass_over_the_words_trie():
    """Forward, backward and best scores are shared by all words with a prefix; long and improbable words give the same by themselves."""
    rng = random.Random(16)
    head = "".join(rng.choice("abé") for _ in range(40))
    tails = ["".join(rng.choice("abcé漢🙂") for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    pieces = {p: -rng.random() * 9 for p in dict.fromkeys("".join(rng.choice("abé漢") for _ in range(rng.randrange(1, 6))) for _ in range(400))}
    trie = token_count.PieceTrie(pieces)
    shared = sorted({head + t for t in tails})
    prefixes = {w[:i] for w in shared for i in range(len(w) + 1)}
    lattice = token_count.Lattice(shared, trie)
    edges = sum(level.piece.size for level in lattice.levels)
    assert lattice.nodes == len(prefixes)
    assert edges == sum(p[i:] in pieces for p in prefixes for i in range(max(0, len(p) - 6), len(p)))

    words = {w: rng.randrange(1, 9) for w in [*shared, *tails, head, "漢" * 200, "🙂" * 250, "ab" * 400, "é" * token_count.LONG, "x" * 300]}
    fallback = token_count.below_all(pieces)
    got, total = token_count.expected_uses(words, pieces, fallback, trie=trie)
    want, likelihood = token_count._walked_uses(words, pieces, fallback)
    assert got == pytest.approx(want, rel=1e-9, abs=1e-12) and total == pytest.approx(likelihood) and list(got) == list(pieces)
    even = dict.fromkeys(pieces, -1.0)  # many cuts of the same score
    for scores in (pieces, even):
        counter = token_count.TrieCounter(scores)
        assert counter.count_new(words) == counter._walked(sorted(words))
    assert token_count.TrieCounter({}).count_new(["a", "é"]) == {"a": 1, "é": 2}
    assert token_count.expected_uses({"a": 2}, {}, -1.0) == ({}, pytest.approx(-2.0))


def test_fit_raises_the_likelihood():
    rng = random.Random(15)
    words = Counter("".join(rng.choice(["the", "re", "a", "b", "s"]) for _ in range(rng.randrange(1, 5))) for _ in range(500))
    pieces = dict.fromkeys(["t", "h", "e", "r", "a", "b", "s", "the", "re", "th", "▁", "▁the"], math.log(1 / 12))
    marked = {"▁" + w: n for w, n in words.items()}
    totals = [token_count.expected_uses(marked, token_count.fitted(words, pieces, k, 1e-9), -50.0)[1] for k in range(5)]
    assert totals == sorted(totals) and totals[-1] > totals[0] + 100
    model = token_count.fitted(words, pieces)
    assert sum(map(math.exp, model.values())) == pytest.approx(1) and model["the"] > model["th"]
