import codecs
import datetime as dt
import json

from pyspark.sql import functions as F

from orderloom.functions import text as X
from orderloom.operators import orders as O
from orderloom.operators import replies as R
from orderloom.sources.payloads import parse_payloads


def payload(order="DH-1", details=None, **master):
    doc = {"master": {"maDonHang": order, "tenKhachHang": "An", "soCT": "C1", **master}}
    if details is not None:
        doc["detail"] = details
    return json.dumps({"apikey": "k", "data": [doc]}, ensure_ascii=False)


def item(code, **over):
    return {"maHang": code, "tenHang": "x", "imei": "i", "soLuong": 1, "doanhThu": 100000, **over}


CASES = {
    1: payload("DH-1", [item("a"), item("b", imei="")]),
    2: payload("BL/2", [item(str(i), doanhThu=100000 * i) for i in range(5)]),
    3: payload("DH-3", []),
    4: payload("DH-4"),
    5: json.dumps({"apikey": "k", "data": []}),
    6: json.dumps({"apikey": "k", "data": [{"detail": [item("a")]}]}),
    7: '{"apikey": "k", "data": [{"mas',
    8: payload("DH-8", [item("a", soLuong="5", doanhThu="x", imei=None)], BoPhan="B", sourceType="store"),
    9: json.dumps({"data": [{"master": {"maDonHang": None}, "detail": [item("a")]}]}),
}


def requests(spark):
    return parse_payloads(spark.createDataFrame(list(CASES.items()), "seq long, payload string")
                          .withColumn("batch_id", F.lit("b")))


def test_parse_and_ids(spark):
    parsed = requests(spark)
    assert [r.seq for r in parsed.where("_corrupt").collect()] == [7]
    assert parsed.where("seq = 7").first().doc is None
    assert sorted(r.seq for r in O.rejected_requests(parsed).collect()) == [5, 6, 7, 9]
    ids = {r.seq: r.task_id for r in O.accepted_requests(parsed).collect()}
    assert ids == {1: "DH-1", 2: "BL/2", 3: "DH-3", 4: "DH-4", 8: "DH-8"}


def test_payload_survives_json(spark):
    again = json.loads(requests(spark).where("seq = 2").select(F.to_json("doc").alias("j")).first().j)
    want = json.loads(CASES[2])
    assert [d["maHang"] for d in again["data"][0]["detail"]] == [d["maHang"] for d in want["data"][0]["detail"]]
    assert [float(d["doanhThu"]) for d in again["data"][0]["detail"]] == [100000.0 * i for i in range(5)]


def test_details(spark):
    parsed = O.task_ids(requests(spark))
    lines = sorted((r.seq, r.pos, r.item.maHang) for r in O.explode_details(parsed).collect())
    assert lines == [(1, 0, "a"), (1, 1, "b"), *[(2, i, str(i)) for i in range(5)], (8, 0, "a"), (9, 0, "a")]
    firsts = {r.seq: (r.master and r.master.tenKhachHang, r.item and r.item.maHang) for r in O.first_detail(parsed).collect()}
    assert firsts == {1: ("An", "a"), 2: ("An", "0"), 3: (None, None), 4: ("An", None), 5: (None, None), 6: (None, None),
                      7: (None, None), 8: ("An", "a"), 9: (None, "a")}


def test_flatten(spark):
    when = dt.datetime(2024, 1, 1)
    replies = spark.createDataFrame(
        [("DH-1", '{"errorCode": null}', "HTTP 500 error", when), ("BL/2", "{}", "HTTP 500 error", when),
         ("DH-8", '{"errorCode": "bad"}', "e", when)], "task_id string, body string, error string, attempt_at timestamp")
    ok = O.accepted_requests(requests(spark))
    rows = {(r.order_id, r.product_code): r for r in O.flatten_order_lines(ok, replies).collect()}
    assert len(rows) == 8
    assert rows["DH-1", "a"].error_code is None and rows["BL/2", "3"].error_code == "HTTP 500 error"
    assert rows["BL/2", "3"].source_type == "offline" and rows["DH-1", "a"].source_type == "online"
    assert float(rows["BL/2", "4"].revenue) == 400000.0
    odd = rows["DH-8", "a"]
    assert (odd.quantity, odd.revenue, odd.imei, odd.department_code, odd.error_code) == (5.0, None, None, None, "bad")
    declared = lambda s: O.flatten_order_lines(ok, replies, "first", s).where("order_id = 'DH-8'").first().source_type
    assert declared("declared") == "store" and declared("declared_checked") == "online"
    assert O.flatten_order_lines(ok, replies, "first").count() == 3


def test_batch_summary_pages(spark):
    df = parse_payloads(spark.createDataFrame(
        [("b1" if i < 25 else "b2", i, payload(f"DH-{i}", [])) for i in range(30)], "batch_id string, seq long, payload string"))
    pages = {(r.batch_id, r.page): r for r in O.batch_summary(df, page=10).collect()}
    assert [len(pages["b1", p].task_ids) for p in range(3)] == [10, 10, 5] and pages["b1", 0].n_tasks == 25
    assert pages["b2", 0].task_ids == [f"DH-{i}" for i in range(25, 30)]


def rule_repair(s):
    try:
        chars = codecs.decode(s.encode(), "unicode_escape")
        return bytes(map(ord, chars)).decode()
    except ValueError:
        return s


def test_repair_of_escapes(spark):
    import random
    import warnings
    warnings.simplefilter("ignore")
    rng = random.Random(2)
    letters = ["\\", "x", "u", "0", "4", "1", "c", "3", "a", "é", "n", "N", "U", " ", "'"]
    texts = ["", "Mã hàng", r"M\xc3\xa3", r"MÃ£", r"ã", r"ộ", r"a\nb\t\\", "x\\", r"\x4", r"\101\7\400",
             r"\N{LATIN SMALL LETTER A}b", r"\N{EURO SIGN}", r"\N{", "a\\\nb", r"\U00000041", "\\\r"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", X.repair_escapes("t").alias("o")).collect():
        assert r.o == rule_repair(r.t), r.t


def test_patterns(spark):
    import re
    # The rule as stated for short messages (fixed value).
    slow = re.compile(r"Mã hàng\s+([^\s]+(?:\s+[^\s]+)*?)\s+không tồn tại trong hệ thống")
    tail = " không tồn tại trong hệ thống"
    texts = ["Mã hàng A B" + tail, "Mã hàng X" + tail + ", Mã hàng Y" + tail + "; Mã hàng X" + tail, "Mã hàng C lỗi, Mã hàng D" + tail,
             "Mã hàng Z không tồn tại trong hệ thống", "Mã hàng " + "w " * 20000 + "không tồn tại trong hệ thống", "khác", "Mã hàng  " + tail]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", X.codes_in_order("t").alias("c"), X.extract_missing_codes("t").alias("s")).collect():
        assert r.c == slow.findall(r.t) and r.s == sorted(set(r.c))
    dup = spark.createDataFrame([("Chứng từ AB đã nhập.",), ("Chứng từ A\nB đã nhập.",), ("Chứng từ đã nhập.",)], "t string")
    assert [r.d for r in dup.select(X.is_duplicate_document("t").alias("d")).collect()] == [True, False, False]
    heads = spark.createDataFrame([("Mã Gốc",), ("ĐƠN GIÁ (vnđ)",), ("Tên_Hàng mới",)], "t string")
    assert [r.h for r in heads.select(X.normalize_header("t").alias("h")).collect()] == ["magoc", "dongiavnd", "tenhangmoi"]


def test_similarity(spark):
    df = spark.createDataFrame([("", None), ("abc", None), ("kitten", "sitting"), ("đá", "da")], "a string, b string")
    got = [(r.d, round(r.s, 4)) for r in df.select(X.edit_distance("a", "b").alias("d"), X.similarity("a", "b").alias("s")).collect()]
    assert got == [(0, 0.0), (3, 0.0), (3, round(1 - 3 / 7, 4)), (2, 0.0)]


MISSING = "Mã hàng {} không tồn tại trong hệ thống"


def test_outcomes(spark):
    said = lambda v: json.dumps({"errorCode": v}, ensure_ascii=False)
    cases = [
        (200, "{}", "completed"), (429, said("x"), "completed"), (301, "{}", "completed"), (501, "{}", "completed"),
        (404, said(MISSING.format("A") + MISSING.format("B")), "retry_missing_code"), (400, said("Chứng từ X đã nhập."), "duplicate_success"),
        (400, said("khác"), "terminal"), (503, said("khác"), "retry_server"), (503, "{}", "completed_unconfirmed"),
        (500, said(None), "completed_unconfirmed"), (500, said(""), "completed_unconfirmed"), (500, said(0), "completed_unconfirmed"),
        (500, said(0.0), "completed_unconfirmed"), (500, said(False), "completed_unconfirmed"), (500, said([]), "completed_unconfirmed"),
        (500, said({}), "completed_unconfirmed"), (404, said(7), "retry_malformed"), (500, said({"a": 1}), "retry_malformed"),
        (500, said("0"), "retry_server"), (500, "[1]", "completed_unconfirmed"), (200, "oops", "completed_unconfirmed"),
        (200, None, "completed"), (404, None, "completed_unconfirmed"), (0, None, "completed_unconfirmed"),
        (404, said(r"M\xc3\xa3 h\xc3\xa0ng Q kh\xc3\xb4ng t\xe1\xbb\x93n t\xe1\xba\xa1i trong h\xe1\xbb\x87 th\xe1\xbb\x91ng"), "retry_missing_code"),
    ]
    df = spark.createDataFrame([(i, s, b, None) for i, (s, b, _) in enumerate(cases)], "i int, status_code int, body string, error string")
    rows = {r.i: r for r in R.outcome_v2(df).collect()}
    assert [rows[i].outcome for i in range(len(cases))] == [c[2] for c in cases]
    assert rows[4].missing_codes == ["A", "B"] and rows[24].missing_codes == ["Q"]
    assert rows[5].error == "Duplicate document detected: Chứng từ X đã nhập." and rows[6].error == "HTTP 400 error"
    simple = {r.i: r for r in R.outcome_simple(df).collect()}
    assert simple[21].outcome == "needs_retry" and simple[21].status == 0  # empty success body
    assert simple[24].missing_codes == [] and simple[24].error_text == MISSING.format("Q")
    assert {simple[i].outcome for i in range(4)} == {"success"}


def test_daily_stats_and_report(spark):
    ts = lambda d, h: dt.datetime(2024, 1, d, h)
    df = spark.createDataFrame([(ts(1, 1), True), (ts(1, 5), False), (ts(2, 0), False)], "attempt_at timestamp, success boolean")
    assert {(str(r.stat_date), r.completed_tasks, r.failed_tasks) for r in R.daily_stats(df).collect()} == {("2024-01-01", 1, 1), ("2024-01-02", 0, 1)}
    codes = R.distinct_codes(spark.createDataFrame([(["b", "a"],), (["a"],), ([],)], "missing_codes array<string>"))
    report = R.missing_code_report(codes, F.lit("2024-01-01 10:00:00").cast("timestamp")).collect()
    assert [tuple(r) for r in report] == [(c, "Not Found", "2024-01-01 10:00:00", "Verify & Add to System") for c in "ab"]


def test_large_order_is_one_request(spark, tmp_path):
    """2,000 lines of one order: one request, numbered through."""
    from orderloom.plans import inputs as I

    for name in ("orders", "customer", "lineitem"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "lineitem":
            lines = df.limit(2000).withColumn("l_orderkey", F.lit(1).cast("long")).withColumn("l_partkey", F.lit(8).cast("long"))
            df = lines.withColumn("l_linenumber", F.monotonically_increasing_id().cast("int"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = I.requests(spark, str(tmp_path)).where("seq = 1")
    assert rows.count() == 1
    items = O.explode_details(parse_payloads(rows)).select("item.imei").collect()
    assert sorted(r.imei for r in items) == sorted(f"IM{i}" for i in range(1, 2001))


def test_documents_without_a_reply_are_not_shuffled(spark):
    """Only documents whose id has a reply's hash reach the exchange before the join."""
    doc = lambda i: json.dumps({"data": [{"master": {"maDonHang": f"o{i}"}, "detail": [{"maHang": "p", "imei": str(i)}]}]})
    requests = O.accepted_requests(parse_payloads(spark.createDataFrame([("b", i, "u", None, doc(i)) for i in range(2000)],
                                                                        "batch_id string, seq long, url string, submitted_at timestamp, payload string")))
    replies = spark.createDataFrame([(f"o{i}", "{}", "e", None) for i in range(0, 2000, 100)] + [("other", "{}", "e", None), (None, "{}", "e", None)],
                                    "task_id string, body string, error string, attempt_at timestamp")
    lines = O.flatten_order_lines(requests, replies)
    assert sorted(r.order_id for r in lines.collect()) == sorted(f"o{i}" for i in range(0, 2000, 100))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    first_join, slots = plan.index("Join Inner"), plan.index("Join LeftSemi")
    assert first_join < slots  # the plan is read from the top: the filter by slots lies below the join
