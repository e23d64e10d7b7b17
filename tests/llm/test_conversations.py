import hashlib
import itertools
import random
import re
import zlib

from orderloom.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, step string, has string, digest string, fault string, edit string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
RIGHT = re.compile(r"(s?(ua)+)?")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def faults(rows):
    seen = set()
    for role, text in rows:
        last = WORD.findall(text)[-1:]
        fault = C.BLANK if not last else C.DUPLICATE if (role, text) in seen else C.CUT_OFF if last[0] not in ".!?" else C.FINE
        seen.add((role, text))
        yield fault


def cheapest(initials, found):
    """All ways to edit, from the last row to the first, with up to two inserts at a place: (cost, letters, role letters) of the best.

    Of ways to the same role letters the best is kept, and only letters that a right sequence can end in.
    """
    end = re.compile(r"s?(ua)+|a?(ua)*")
    ways = {"": (0, "")}
    for i in range(len(initials), -1, -1):
        if i < len(initials):
            options = [(3, "D", "")]
            if found[i] not in (C.BLANK, C.DUPLICATE):
                extra = 1 if found[i] == C.CUT_OFF else 0
                options += [(extra, "K", initials[i] or "?"), (2 + extra, "R", "u"), (2 + extra, "R", "a")]
            ways = best_of(end, [(x + y, (c + d, a + b)) for c, a, x in options for y, (d, b) in ways.items()])
        ways = best_of(end, [(x + y, (2 * len(x) + d, "I" * len(x) + b)) for x in ("", "u", "a", "ua", "au") for y, (d, b) in ways.items()])
    return min((*way, x) for x, way in ways.items() if RIGHT.fullmatch(x))


def best_of(end, offers):
    best = {}
    for x, way in offers:
        if end.fullmatch(x) and way < best.get(x, (10 ** 9, "")):
            best[x] = way
    return best


def repaired(rows, audit, letters):
    """Rows after the edits."""
    out, kept, at = [], iter(letters), 0
    names = {"u": "user", "a": "assistant"}
    for edit in audit:
        if edit == "I":
            out.append((names[next(kept)], ""))
            continue
        role, text = rows[at]
        at += 1
        if edit == "K":
            next(kept)
            out.append((role, text))
        elif edit == "R":
            out.append((names[next(kept)], text))
    return out


def brute(rows):
    """Per conversation what the query returns."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        turns = {r[1] for r in mine if r[1] is not None}
        plain = [(role, text) for _, _, role, text in mine]
        found = list(faults(plain))
        initials = [role[:1] for role, _ in plain]
        cost, audit, letters = cheapest(tuple(initials), tuple(found))
        text = "\n".join(f"{role}:{text}" for role, text in repaired(plain, audit, letters))
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count(C.BLANK), found.count(C.DUPLICATE),
                     found.count(C.CUT_OFF), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def result(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}


def test_against_every_way_of_editing(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "cut", " ", "", None, "a ", "é?", "Yes. \n", "!", "long " * 400 + "end."]
    rows = []
    for conv in range(120):
        for _ in range(rng.randrange(1, 7)):
            turn = rng.choice([None, *range(6)])
            rows.append((conv if conv else None, turn, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "s", "User"]),
                         rng.choice(texts)))
    got = result(C.damaged_and_repaired(table(spark, rows).repartition(7)))
    want = brute(rows)
    assert got == want


def test_viterbi_against_every_way():
    """All short role sequences, and random faults: the cost and the letters."""
    rng = random.Random(9)
    cases = [(c, (C.FINE,) * n) for n in range(5) for c in itertools.product("suat", repeat=n)]
    cases += [(tuple(rng.choice("suat") for _ in range(n)), tuple(rng.randrange(4) for _ in range(n))) for n in (4, 5, 6, 7) for _ in range(150)]
    for initials, found in cases:
        letters = []
        best = C.Survivors(letters.append)
        for initial, fault in zip(initials, found):
            best.push(initial, fault)
        cost = best.finish()
        assert (cost, "".join(letters)) == cheapest(initials, found)[:2]


def full_dp(initials, found):
    """Whole ways per state, kept as strings."""
    def inserts(ways):
        for _ in range(3):
            for s, (c, a) in list(ways.items()):
                to = C.NEXT[s][C.GIVEN[s]]
                ways[to] = min(ways.get(to, (10 ** 9, "")), (c + 2, a + "I"))
        return ways
    ways = inserts({0: (0, "")})
    for initial, fault in zip(initials, found):
        after = {}
        for s, (c, a) in ways.items():
            offers = [(s, 3, "D")]
            if fault not in (C.BLANK, C.DUPLICATE):
                extra = int(fault == C.CUT_OFF)
                offers += [(C.NEXT[s][C.GIVEN[s]], 2 + extra, "R")] + ([(C.NEXT[s][initial], extra, "K")] if initial in C.NEXT[s] else [])
            for to, cost, letter in offers:
                after[to] = min(after.get(to, (10 ** 9, "")), (c + cost, a + letter))
        ways = inserts(after)
    return min(ways[s] for s in (0, 3) if s in ways)


def test_long_conversations_stay_small():
    """Edits leave as soon as they are final, and the tree never has more than a few nodes."""
    def nodes(n):
        return 1 + sum(map(nodes, n.branches))
    rng = random.Random(2)
    for alphabet, faults_ in (("ua", 1), ("suat", 4), ("t", 1), ("u", 1), ("a", 2)):
        initials = [rng.choice(alphabet) for _ in range(1500)]
        found = [rng.randrange(faults_) for _ in range(1500)]
        letters = []
        best = C.Survivors(letters.append)
        for initial, fault in zip(initials, found):
            best.push(initial, fault)
            assert nodes(best.root) <= 8
        before = sum(map(len, letters))
        cost = best.finish()
        assert (cost, "".join(letters)) == full_dp(initials, found)
        if alphabet in ("ua", "suat"):
            assert before > 1000


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Hello."), (1, 2, "assistant", "Yes"), (1, 3, "user", "Why?"), (2, 0, "tool", "Go."),
            (3, 0, "assistant", "Only me."), (4, 0, "user", " \t")]
    got = C.repair(table(spark, rows)).orderBy("conv_id", "step").collect()
    assert [(r.conv_id, r.edit, r.role, r.text, r.fault) for r in got] == list(expected(rows))
    assert all(r.step == i for _, g in itertools.groupby(got, key=lambda r: r.conv_id) for i, r in enumerate(g))


def expected(rows):
    for conv in sorted({r[0] for r in rows}):
        mine = [(r[2], r[3]) for r in rows if r[0] == conv]
        found = list(faults(mine))
        _, audit, letters = cheapest(tuple(r[:1] for r, _ in mine), tuple(found))
        after, at = iter(repaired(mine, audit, letters)), 0
        for edit in audit:
            if edit == "I":
                yield (conv, edit, *next(after), None)
                continue
            yield (conv, edit, *(mine[at] if edit == "D" else next(after)), found[at])
            at += 1


def test_empty_table_and_dropped_conversations(spark):
    assert C.damaged_and_repaired(table(spark, [])).count() == 0
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert result(C.damaged_and_repaired(table(spark, [(conv, 0, "user", "a.")]))) == {
        conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_one_hot_conversation(spark):
    rng = random.Random(6)
    rows = [(5, t, rng.choice(["user", "assistant"]), f"text {t % 500}.") for t in range(4000)] + [(6, 0, "user", "a."), (6, 1, "assistant", "b.")]
    got = result(C.damaged_and_repaired(table(spark, rows)))
    mine = sorted((r for r in damaged(rows) if r[0] == 5), key=lambda r: r[1])
    plain = [(role, text) for _, _, role, text in mine]
    found = list(faults(plain))
    cost, audit = full_dp([r[:1] for r, _ in plain], found)
    assert (got[5][5], got[5][6], got[5][2]) == (cost, audit, found.count(C.DUPLICATE))
