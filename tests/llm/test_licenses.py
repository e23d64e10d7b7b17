import random
import re

from orderloom.llm import licenses as L
from orderloom.llm.license_texts import PHRASES, TEMPLATES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def base(text):
    """(start, label) of every phrase, by comparing at every place."""
    mine = words(text)
    return sorted((i, label) for phrase, label in PHRASES.items() for p in [phrase.split()]
                  for i in range(len(mine)) if mine[i:i + len(p)] == p)


def test_matching_statistics_against_all_stretches():
    rng = random.Random(1)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 5))]
        a = L.Automaton(sequences)
        text = [rng.randrange(4) for _ in range(40)]
        for i, (state, length) in enumerate(a.walk(text)):
            places = lambda n: {(s, e) for s, q in enumerate(sequences) for e in range(n, len(q) + 1) if q[e - n:e] == text[i + 1 - n:i + 1]}
            longest = max((n for n in range(1, i + 2) if places(n)), default=0)
            assert length == longest
            if length:
                assert set(a.places[state]) == places(length)
        assert len(a.length) <= 2 * (sum(map(len, sequences)) + len(sequences))


def brute_chain(anchors):
    """Most covered words of a rising chain, by all subsets in order."""
    anchors = sorted(set(anchors))
    best = 0

    def go(last, covered, rest):
        nonlocal best
        best = max(best, covered)
        for i, (at, t_at, n) in enumerate(rest):
            overlap = max(0, last[0] + last[2] - at, last[1] + last[2] - t_at)
            if last[0] < at and last[1] < t_at and overlap < n and at - last[0] - last[2] <= L.GAP:
                go((at, t_at, n), covered + n - overlap, rest[i + 1:])

    for i, a in enumerate(anchors):
        go(a, a[2], anchors[i + 1:])
    return best


def test_chains_against_all_subsets():
    rng = random.Random(2)
    for _ in range(200):
        anchors = [(rng.randrange(40), rng.randrange(30), rng.randrange(4, 9)) for _ in range(rng.randrange(1, 9))]
        found = L.chains(anchors)
        assert found[0][4] == brute_chain(anchors)
        places = sorted((a, b) for a, b, *_ in found)
        assert all(b <= c for (_, b), (c, _) in zip(places, places[1:]))


def scan(text):
    return L.scanner(tuple(PHRASES.items()), tuple(TEMPLATES)).scan(text.encode())


def test_each_template_is_found_whole_and_damaged():
    rng = random.Random(3)
    for label, text in TEMPLATES:
        n, _, spans, score = scan(f"Some words before it. {text} And after.")
        assert label in {s.label for s in spans} and score == 1.0
        span = next(s for s in spans if s.label == label)
        assert (span.start, span.end, span.share) == (4, n - 2, 1.0)
        split = text.split()
        if len(split) > 40:
            for at in rng.sample(range(len(split)), len(split) // 30):
                split[at] = "changed"
            assert label in {s.label for s in scan(" ".join(split))[2]}
            assert scan(" ".join(reversed(split)))[2] == []


def test_many_copies_and_long_texts():
    text = TEMPLATES[0][1]
    n, _, spans, _ = scan(" and the ".join([text] * 3000))
    assert [s.label for s in spans] == ["mit"] * 3000 and n == 3000 * len(words(text)) + 2 * 2999
    assert scan("of the software and " * 200_000)[2] == []


def test_scan_of_documents(spark, odd, odd_pairs, empty):
    from tests.llm.conftest import make
    phrases = ["the MIT  License", "mit-license", "MIT licence", "Apache\nLicense apache license", "GNU General Public License", "mit mit license license",
               "general public-license.", "übermit license", "mité license", "MİT license", TEMPLATES[3][1], None, "", "mit license " * 50_000]
    pairs = [*odd_pairs, *[(1000 + i, t) for i, t in enumerate(phrases)], (1000, "mit license"), (None, "apache license")]
    got = L.license_scan(make(spark, pairs).repartition(4)).collect()
    assert len(got) == len(pairs)
    want = []
    for doc_id, text in pairs:
        found = base(text)
        want.append((doc_id, len(words(text)), len(found), found[0][0] if found else None, found[-1][0] if found else None,
                     ",".join(sorted({label for _, label in found}))))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
    assert L.license_scan(empty).count() == 0


def test_pieces_cut_between_words(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("ab Z9_-éß\n.") for _ in range(5000))
    want = [w.encode() for w in words(text)]
    for piece in (1, 7, 100):
        monkeypatch.setattr(L, "PIECE", piece)
        assert [w for part in L.words_of(text.encode()) for w in part] == want
