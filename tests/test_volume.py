"""What is shuffled and kept: plans of the changes, and numbering of large orders."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from orderloom.operators import ledger as L
from orderloom.operators import orders as O
from orderloom.plans import inputs as I
from orderloom.plans.catalog import REGISTRY
from tests.test_ledger import frame, row


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def lines_of(spark, tmp_path):
    """Five orders, one of 40 lines, with repeated lines and a line without an order."""
    day = dt.datetime(1995, 1, 1)
    rows = [(k, p % 7, p % 3, 1 + p % 4, float(p % 5), 10.0, 0.1, 0.0, "R", "F", day) for k, n in ((1, 40), (2, 3), (3, 1), (4, 6), (None, 9)) for p in range(n)]
    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
              "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = [(k, 1, "F", 1.0, day, "1-URGENT") for k in (1, 2, 3, 4, 5)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                                  "o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, "c", 2, 1.0, "AUTO")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(
        str(tmp_path / "customer.parquet"))
    return rows


def test_lines_are_numbered_within_their_order_also_in_chunks(spark, tmp_path, monkeypatch):
    rows = lines_of(spark, tmp_path)
    want = sorted((k, n, *r[1:]) for k in (1, 2, 3, 4) for n, r in enumerate(sorted(
        (r for r in rows if r[0] == k), key=lambda r: (r[3], *r[1:3], *r[4:])), 1))
    for large in (100_000, 5):
        monkeypatch.setattr(I, "LARGE_ORDER", large)
        got = I.numbered_lines(spark, str(tmp_path))
        assert sorted((r.l_orderkey, r.line_no, *(r[c] for c in got.columns if c not in ("l_orderkey", "line_no"))) for r in got.collect()) == want


def test_rules_are_counted_in_one_pass(spark, tmp_path):
    """The lines are read and numbered once for all rules, and keys are shuffled once."""
    lines_of(spark, tmp_path)
    made = L.ledger_violations(I.raw_ledger(spark, str(tmp_path)))
    assert plan(made).count("Window") == 1 and plan(made).count("hashpartitioning(order_id") == 1


def test_large_orders_are_found_by_slots(spark, tmp_path, monkeypatch):
    lines_of(spark, tmp_path)
    lines = I.table(spark, str(tmp_path), "lineitem").where("l_orderkey IS NOT NULL")
    assert I.large_orders(lines) is None
    monkeypatch.setattr(I, "LARGE_ORDER", 6)
    for slots in (1, 1 << 14):  # in one slot with small orders, and nearly alone
        monkeypatch.setattr(I, "ORDER_SLOTS", slots)
        assert {r.l_orderkey for r in I.large_orders(lines).collect()} == {1, 4}
    monkeypatch.setattr(I, "LARGE_ORDER", 45)
    monkeypatch.setattr(I, "ORDER_SLOTS", 1)
    assert I.large_orders(lines) is None  # a full slot of small orders


def test_a_request_numbers_its_lines_by_itself(spark, tmp_path):
    """One shuffle of the lines, and the numbers of the numbered table in the document."""
    lines_of(spark, tmp_path)
    made = I.requests.__wrapped__(spark, str(tmp_path))
    assert plan(made).count("REPARTITION") == 1 and "Window" not in plan(made)
    numbers = {r.l_orderkey: r.n for r in I.numbered_lines(spark, str(tmp_path)).where("l_partkey % 7 != 0").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.concat(F.lit("IM"), F.col("line_no").cast("string")))).alias("n")).collect()}
    found = made.select("seq", F.from_json(F.get_json_object("payload", "$.data[0].detail"), "array<struct<imei string>>").alias("d"))
    found = {r.seq: sorted(x.imei for x in r.d or () if x.imei) for r in found.collect()}
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in numbers.items() if v}


def test_changes_shuffle_each_side_once(spark):
    orders, lines = frame(spark, [row("o", "p", "1")]), frame(spark, [row("o", "p", "1")]).withColumn("pos", F.lit(0))
    assert plan(L.update_lines(orders, lines)).count("Exchange") == 1
    assert "hashpartitioning(order_id" in plan(L.replace_duplicates(lines))


def test_arriving_requests_are_stored_compressed(spark, tmp_path):
    lines_of(spark, tmp_path)
    before = set(glob.glob(spark.conf.get("spark.checkpoint.dir") + "/orderloom/*/requests-*/*.json*"))
    REGISTRY["stream_requests"](spark, str(tmp_path))
    new = set(glob.glob(spark.conf.get("spark.checkpoint.dir") + "/orderloom/*/requests-*/*.json*")) - before
    assert new and all(p.endswith(".gz") for p in new)


def test_documents_without_a_reply_go_however_many_replies_there_are(spark, monkeypatch):
    monkeypatch.setattr(O, "REPLY_SLOTS", 64)
    requests = spark.range(4000).select(F.concat(F.lit("T"), "id").alias("task_id"))
    replies = requests.where("substr(task_id, 2) % 10 = 3")
    stay = O.likely_answered(requests, replies, "task_id")
    assert replies.exceptAll(stay).isEmpty() and stay.count() < 800  # 400 of them have a reply


def test_a_replay_shuffles_the_old_rows_once(spark):
    """Old rows meet lines, inserts and deliveries in one exchange by their order, and no join shuffles their values again."""
    old, new = frame(spark, [row("o", "p", "1")]), frame(spark, [row("o", "p", "1")])
    done = spark.createDataFrame([("x", dt.datetime(2024, 1, 1), 1)], "order_id string, attempt_at timestamp, attempt_no long")
    made = L.ledger_replay(new.withColumn("attempt_no", F.lit(1).cast("long")).withColumn("pos", F.lit(0)), done, old)
    assert plan(made).count("REPARTITION") == 1 and plan(made).count("customer_name") > 0
    assert not [x for x in plan(made).splitlines() if "Join" in x and "product_code" in x]


def test_requests_and_ledger_come_from_one_table_of_lines(spark, tmp_path, monkeypatch):
    """The lines are shuffled once for both; with large orders the ledger is numbered in chunks and has the same rows."""
    lines_of(spark, tmp_path)
    here = str(tmp_path)
    small = I.ledger.__wrapped__(spark, here)
    assert "REPARTITION" not in plan(small) and "REPARTITION" not in plan(I.requests(spark, here))
    monkeypatch.setattr(I, "LARGE_ORDER", 5)
    large = I.ledger.__wrapped__(spark, here)
    assert small.count() == 50 and small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
