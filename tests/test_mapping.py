import random

from pyspark.sql import functions as F

from orderloom.operators import mapping as M
from orderloom.sources.tables import as_data, as_mapping, resolve_columns, find_column, MAPPING_PATTERNS, OLD_CODE
import pytest


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute_best(code, rows):
    """rows: (row_no, old, old_name, new, new_name) in row order."""
    usable = [r for r in rows if r[3]]
    same = [r for r in usable if r[3].startswith(code[:3])]
    best, top = None, 0
    for r in same or usable:
        longest = max(len(code), len(r[3]))
        d = lev(code, r[3])
        if 10 * (longest - d) >= 7 * longest and (1 - d / longest) > top:
            best, top = r[1], 1 - d / longest
    return best or None


def brute_apply(data, rows):
    code_of = {r[1]: r[3] for r in rows}
    name_of = {r[1]: r[4] for r in rows}
    back = {r[3]: r[1] for r in rows if r[3]}
    out, stats = [], dict(e=0, r=0, f=0)
    for no, code, name in data:
        new, new_name = code_of.get(code), name_of.get(code)
        stats["e"] += new is not None
        if not new and code and code in back:
            new, new_name = code_of.get(back[code], ""), name_of.get(back[code], "")
            stats["r"] += 1
        if not new and code:
            best = brute_best(code, rows)
            if best:
                new, new_name = code_of.get(best, ""), name_of.get(best, "")
                stats["f"] += 1
        out.append((no, new or code, new_name or name))
    return out, stats


def mutate(rng, text, alphabet, edits):
    text = list(text)
    for _ in range(edits):
        op, at = rng.randrange(3), rng.randrange(len(text) + 1)
        if op == 0:
            text.insert(at, rng.choice(alphabet))
        elif text and op == 1:
            del text[min(at, len(text) - 1)]
        elif text:
            text[min(at, len(text) - 1)] = rng.choice(alphabet)
    return "".join(text)


@pytest.mark.parametrize("seed,low,high,alphabet", [
    (1, 1, 9, "AB1"), (2, 3, 14, "ABđ12"), (3, 12, 30, "AB12"), (4, 14, 40, "XYZ0123"), (5, 1, 24, "Q7")])
def test_cascade_equals_row_by_row_rule(spark, seed, low, high, alphabet):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))
    olds = ["o" + str(rng.randrange(60)) for _ in range(80)]
    rows = []
    for i, old in enumerate(olds):
        new = "" if rng.random() < 0.1 else (rng.choice(rows)[3] if rows and rng.random() < 0.15 else word())
        rows.append((i, "" if rng.random() < 0.05 else old, "n", new, "" if rng.random() < 0.1 else f"name{i}"))
    data = []
    for i in range(220):
        kind = rng.random()
        base = rng.choice(rows)
        code = (base[1] if kind < 0.15 else base[3] if kind < 0.25 else "" if kind < 0.28 else None if kind < 0.3
                else word() if kind < 0.4 else mutate(rng, base[3], alphabet, rng.randint(1, max(1, len(base[3]) // 3))))
        data.append((i, code, f"d{i}"))
    mapping = spark.createDataFrame(rows, "row_no long, old_code string, old_name string, new_code string, new_name string")
    df = spark.createDataFrame(data, "row_no long, `Mã hàng` string, `Tên hàng` string")
    want, stats = brute_apply(data, rows)
    got = sorted(tuple(r) for r in M.apply_mapping(df, mapping).collect())
    assert got == want
    s = M.mapping_stats(df, mapping).first()
    assert (s.exact_matched_count, s.reverse_matched_count, s.fuzzy_matched_count) == (stats["e"], stats["r"], stats["f"])
    assert s.matched_count == sum(stats.values()) and s.total_count == len(data)


def test_threshold_is_met_exactly_and_ties_take_the_first_row(spark):
    mapping = spark.createDataFrame(
        [(0, "a", "", "ABCDEFGHIJ", "x"), (1, "b", "", "ABCDEFGXYZ", "y"), (2, "c", "", "QQQQ1", "z"), (3, "d", "", "QQQQ2", "w")],
        "row_no long, old_code string, old_name string, new_code string, new_name string")
    codes = spark.createDataFrame([("ABCDEFG123",), ("ABCDEF1234",), ("QQQQ3",), ("ABCDEFGHI",)], "code string")
    got = {r.code: (r.best_old, round(r.similarity, 3)) for r in M.best_matches(codes, mapping).collect()}
    assert got == {"ABCDEFG123": ("a", 0.7), "QQQQ3": ("c", 0.8), "ABCDEFGHI": ("a", 0.9)}


def test_column_resolution():
    assert resolve_columns(["Mã gốc", "Tên gốc", "Mã mới", "Tên mới"], MAPPING_PATTERNS) == {
        "old_code": "Mã gốc", "old_name": "Tên gốc", "new_code": "Mã mới", "new_name": "Tên mới"}
    assert resolve_columns(["old_code", "old_name", "new_code", "new_name"], MAPPING_PATTERNS)["new_name"] == "new_name"
    with pytest.raises(ValueError, match="new_name"):
        resolve_columns(["old_code", "old_name", "new_code"], MAPPING_PATTERNS)
    assert find_column(["Mã cũ", "Mã  cũ "], OLD_CODE) == "Mã  cũ "


def test_headers_of_mapping_and_data(spark):
    m = spark.createDataFrame([(0, "a", None, "b", "c")], "row_no long, `Mã gốc` string, `Tên gốc` string, `Mã mới` string, `Tên mới` string")
    assert as_mapping(m).first().asDict() == {"row_no": 0, "old_code": "a", "old_name": "", "new_code": "b", "new_name": "c"}
    d = spark.createDataFrame([("a", "b", 1)], "`Product code` string, `Product name` string, extra int")
    assert as_data(d).columns == ["Mã hàng", "Tên hàng", "extra"]
    with pytest.raises(ValueError):
        as_data(spark.createDataFrame([(1,)], "x int"))


@pytest.mark.parametrize("seed,low,high,tail,n_rows,n_codes", [(7, 15, 60, "", 30, 60), (8, 195, 225, "", 8, 16), (9, 3, 10, "-COMMON-TAIL-2024", 40, 80)])
def test_long_codes_and_common_tails(spark, seed, low, high, tail, n_rows, n_codes):
    """On both sides of every length at which another way of finding candidates takes over."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ABC12") for _ in range(rng.randint(low, high))) + tail
    rows = [(i, f"o{i}", "n", word(), f"name{i}") for i in range(n_rows)]
    codes = {mutate(rng, rng.choice(rows)[3], "ABC12", rng.randint(1, max(2, (low + high) // 7))) for _ in range(n_codes)}
    mapping = spark.createDataFrame(rows, "row_no long, old_code string, old_name string, new_code string, new_name string")
    got = {r.code: r.best_old for r in M.best_matches(spark.createDataFrame([(c,) for c in codes], "code string"), mapping).collect()}
    want = {c: b for c in codes if (b := brute_best(c, rows))}
    assert got == want
