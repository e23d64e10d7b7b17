from pyspark.sql import functions as F

from orderloom.operators import reconcile as C
from orderloom.sources import tables as TB

KEY = "Số điện thoại"


def sides(spark):
    a = spark.createDataFrame([("1", "x", 1.0, "l"), ("2", "y", None, "l"), ("3", None, 3.0, "l"), ("3", "d", 3.0, "l"),
                               (None, None, None, None), ("9", "z", 9.0, "l")], f"`{KEY}` string, name string, v double, only_a string")
    b = spark.createDataFrame([(1, "x", 2.0), (2, None, None), (3, "q", 3.0), (7, "w", 1.0), (7, "w", 1.0), (None, "n", 0.0)],
                              f"`{KEY}` long, name string, v double")
    return a, b


def test_keys(spark):
    a, b = sides(spark)
    assert C.choose_key(a.columns, b.columns) == KEY
    assert C.choose_key(["q", "b", "a"], ["a", "b"]) == "b"
    assert [r[KEY] for r in C.keys_only_left(a, b, KEY).collect()] == ["9"]
    assert [r[KEY] for r in C.keys_only_right(a, b, KEY).collect()] == [7, 7]
    assert sorted(r.key for r in C.common_keys(a, b, KEY).collect()) == ["1", "2", "3"]
    ops = {(r.op, r.key) for r in C.key_set_ops(a, b, KEY).collect()}
    assert len([o for o in ops if o[0] == "union"]) == 5 and ("left_minus_right", "9") in ops and ("right_minus_left", "7") in ops
    assert [(r.side, r.key) for r in C.sample_keys(a, b, KEY).collect()] == [("left", "9"), ("right", "7")]


def test_values_and_counts(spark):
    a, b = sides(spark)
    got = {tuple(r) for r in C.value_differences(a, b, KEY).collect()}
    assert got == {("1", "v", "1.0", "2.0"), ("2", "name", "y", None)}
    assert {r.Key for r in C.value_differences(a, b, KEY, limit=1).collect()} == {"1"}
    assert C.value_differences(a, b, KEY, left_name="crm", right_name="book").columns == ["Key", "Column", "crm_Value", "book_Value"]
    freq = {r.key: (r.left_count, r.right_count, r.difference) for r in C.frequency_differences(a, b, KEY).collect()}
    assert freq == {"3": (2, 1, 1), "7": (0, 2, -2), "9": (1, 0, 1)}
    assert [r.key for r in C.frequency_top(a, b, KEY, 2).collect()] == ["7", "3"]
    assert {r.key: r.n for r in C.value_counts(a, KEY).collect()} == {"1": 1, "2": 1, "3": 2, "9": 1}
    assert C.distinct_key_count(a, KEY).first().n_keys == 4
    assert tuple(C.null_profile(a, KEY).first()) == (1, 1)
    assert tuple(C.summary(a, b, KEY).first()) == (6, 4, 6, 3, 1, 2)
    profile = {(r.kind, r.name): (r.n_rows, r.n_cols) for r in C.column_profile(a, b).collect()}
    assert profile["shape", "left"] == (6, 4) and ("left_only", "only_a") in profile and len(profile) == 6
    assert [r.v for r in C.preview(a.where("v IS NOT NULL"), a.where("false"), ["v"], 2).collect()] == [1.0, 3.0]


def test_diffs_round_trip(spark, tmp_path):
    a, b = sides(spark)
    paths = TB.write_diffs(C.keys_only_left(a, b, KEY), C.keys_only_right(a, b, KEY), C.value_differences(a, b, KEY), str(tmp_path / "d"))
    assert TB.read_string_table(spark, paths["only_left"]).first()[KEY] == "9"
    assert TB.read_inferred_table(spark, paths["only_right"]).count() == 2
    assert TB.read_string_table(spark, paths["value_differences"], fill_blank=True).where("right_Value = ''").count() == 1
    out = TB.write_mapped(a, str(tmp_path / "m"))
    assert spark.read.parquet(out).columns == a.columns


def test_key_sketches_merge_within_their_error(spark):
    rows = spark.range(400_000).selectExpr("id % 4 AS day", "IF(id % 50 = 0, NULL, hash(id) % (20000 * (id % 4 + 1))) AS k")
    exact = {r.day: r.n for r in rows.groupBy("day").agg(F.countDistinct("k").alias("n")).collect()}
    whole = {r.day: r.n_keys for r in C.sketched_key_count(C.key_sketches(rows, "k", ["day"]), ["day"]).collect()}
    parts = C.key_sketches(rows.where("k % 2 = 0"), "k", ["day"]).unionByName(C.key_sketches(rows.where("k % 2 <> 0"), "k", ["day"]))
    merged = {r.day: r.n_keys for r in C.sketched_key_count(parts, ["day"]).collect()}
    assert all(abs(n - exact[d]) <= 4 * C.sketch_error() * exact[d] for got in (whole, merged) for d, n in got.items()) and set(whole) == set(exact)
    assert max(len(r.sketch) for r in parts.collect()) <= 2 ** C.SKETCH_BITS + 64
    small = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert C.sketched_key_count(C.key_sketches(small, "k")).first().n_keys == 2


def test_one_file_with_line_breaks_feeds_many_tasks(spark, tmp_path):
    """Cells with line breaks, quotes, commas and carriage returns, cut at every kind of place by small splits: the rows that were written."""
    import csv
    import random
    rng = random.Random(3)
    cell = lambda: rng.choice(["", "plain", "a,b", 'say "x"', "two\nlines", 'q"\n"', "\n", "é\r\nz", "1", '"', "x" * 300, "\n\n\n,,\"\"\n", "  pad "])
    rows = [(str(i), cell(), cell(), cell()) for i in range(3000)]
    for name, end in (("unix", "\n"), ("dos", "\r\n")):
        path = str(tmp_path / f"{name}.csv")
        with open(path, "w", newline="", encoding="utf-8") as f:
            csv.writer(f, lineterminator=end).writerows([("id", "a\nb", "c", "c2"), *rows])
        whole = spark.read.csv(path, header=True, multiLine=True, escape='"').collect() if name == "unix" else None
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4001")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            split = TB.read_string_table(spark, path)
            got = split.collect()
            placed = TB.read_string_table(spark, path, place="place").orderBy("place").select("id").collect()
            assert [r.id for r in placed] == [r[0] for r in rows]
            assert TB.csv_records(spark, path).select("record").rdd.getNumPartitions() > 1
            assert spark.read.text(path).rdd.getNumPartitions() > 50
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert split.columns == ["id", "a\nb", "c", "c2"] and len(got) == 3000
        assert sorted(map(str, map(tuple, got))) == sorted(str(tuple(c or None for c in r)) for r in rows) if name == "dos" else sorted(map(str, got)) == sorted(map(str, whole))


def test_inferred_types_of_csv(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as f:
        f.write("i,l,d,day,ts,flag,text,none,code\n1,5000000000,1.5,2024-01-02,2024-01-02 03:04:05,true,x,,007\n-2,1,2,2024-02-01,2024-01-02 00:00:00,FALSE,1,,8\n,,,,,,,,\n")
    got = TB.read_inferred_table(spark, path)
    want = spark.read.csv(path, header=True, inferSchema=True, multiLine=True, escape='"')
    assert [d for _, d in got.dtypes] == [d for _, d in want.dtypes]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
