"""Operator inputs derived from the star-schema tables, by rules that SQL can state as well.

All rules run over whole tables. ``plans/oracle.py`` states the same rules in SQL, starting from
the tables and not from the JSON made here.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.operators import replies as R
from orderloom.operators.orders import accepted_requests, flatten_order_lines
from orderloom.operators.ledger import replace_duplicates
from orderloom.operators.scan import row_numbers
from orderloom.schema import LEDGER, LEDGER_COLUMNS
from orderloom.session import materialize, shuffle_width
from orderloom.sources.payloads import parse_payloads

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate")
#: What requests and ledger take from a line.
LINE_VALUES = ("l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")

_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(make):
    """Derive an input once per session and folder and keep it as a table, as a feed would arrive."""
    @functools.wraps(make)
    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
        if key not in _STORED:
            _STORED[key] = materialize(make(spark, sf_dir), make.__name__)
        return _STORED[key]
    return load


def taken_from(source):
    """An input that is a projection of a stored one, and so isn't kept itself. ``__wrapped__`` derives both anew."""
    def projected(make):
        @functools.wraps(make)
        def load(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(source(spark, sf_dir))
        load.__wrapped__ = lambda spark, sf_dir: make(source.__wrapped__(spark, sf_dir))
        return load
    return projected


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(c) -> Column:
    return F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp")


def now() -> Column:
    return F.lit("1998-06-01 00:00:00").cast("timestamp")


def padded(c: Column, width: int, head: str) -> Column:
    return F.concat(F.lit(head), F.lpad(c.cast("string"), width, "0"))


def order_number() -> Column:
    key = F.col("o_orderkey").cast("string")
    return F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("BL/"), "c_mktsegment", F.lit("/"), key)).otherwise(
        F.concat(F.lit("DH-"), key))


#: Lines from which on an order is numbered in chunks, and lines of a task where whole orders meet.
LARGE_ORDER, TASK_LINES = 100_000, 500_000
#: Hash slots by which lines are counted before they are counted by their order.
ORDER_SLOTS = 1 << 14


def by_order(lines: DataFrame) -> DataFrame:
    """Lines of orders, each order in one task, in as many tasks as the lines need: sorts there stay in memory."""
    spark = lines.sparkSession
    return lines.repartition(max(shuffle_width(spark), -(-lines.count() // TASK_LINES)), "l_orderkey")


def large_orders(lines: DataFrame) -> DataFrame | None:
    """The orders of ``LARGE_ORDER`` lines or more; None if there are none. Lines are first counted per hash slot, so only those of slots
    with as many lines, if any, are counted by their order."""
    slot = F.pmod(F.xxhash64("l_orderkey"), F.lit(ORDER_SLOTS)).cast("int").alias("_slot")
    full = materialize(lines.groupBy(slot).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LARGE_ORDER).select("_slot"), "large-slots")
    if full.isEmpty():
        return None
    counts = lines.select("l_orderkey", slot).join(F.broadcast(full), "_slot", "left_semi").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(counts.where(F.col("n") >= LARGE_ORDER).select("l_orderkey"), "large-orders")
    return None if large.isEmpty() else large


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with ``line_no`` inside the order, whatever the order's size. Lines without an order number, which have no order, are left out.

    Lines are shuffled once and stay dealt by their order, so a join on it moves only the other side. Only those of large orders, of which there are few, are numbered over ordered chunks, so no task takes all
    lines of a large order.
    """
    lines = table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL")
    large = large_orders(lines)
    one_task = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    if large is None:
        return by_order(lines).withColumn("line_no", F.row_number().over(one_task).cast("long"))
    # at most one row for each LARGE_ORDER lines
    rest = by_order(lines.join(F.broadcast(large), "l_orderkey", "left_anti")).withColumn("line_no", F.row_number().over(one_task).cast("long"))
    return rest.unionByName(row_numbers(lines.join(F.broadcast(large), "l_orderkey", "left_semi"), ["l_orderkey"], LINE_ORDER, "line_no"))


def item_imei(part: Column, line_no: Column) -> Column:
    return F.when(part % 7 == 0, "").when(part % 11 == 0, None).otherwise(F.concat(F.lit("IM"), line_no.cast("string")))


@stored
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer and its lines in order, from which both requests and ledger are taken: lines are shuffled once
    for both. An order's lines meet in one row, as they do in its request by nature."""
    lines = table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL").select("l_orderkey", *LINE_ORDER)
    detail = (by_order(lines).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*LINE_ORDER))).alias("_d"))
              .select("l_orderkey", F.transform("_d", lambda x: F.struct(*[x[c].alias(c) for c in LINE_VALUES])).alias("lines")))
    return (table(spark, sf_dir, "orders")
            .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(detail, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "lines"))


@taken_from(order_lines)
def requests(orders: DataFrame) -> DataFrame:
    """One JSON order request per order; some are cut short and some lack their order number.

    A request is one document, so its lines meet in one row by nature, and are numbered there.
    """
    def item(line: Column, n: Column) -> Column:
        part = line["l_partkey"]
        return F.struct(
            padded(part, 6, "P").alias("maHang"), F.concat(F.lit("Part "), part.cast("string")).alias("tenHang"),
            item_imei(part, n + 1).alias("imei"), line["l_quantity"].alias("soLuong"), line["l_extendedprice"].alias("doanhThu"))

    orders = orders.withColumn("detail", F.transform("lines", item))
    no_lines = F.array().cast(orders.schema["detail"].dataType)
    key = F.col("o_orderkey")
    declared = F.when(key % 5 == 0, None).when(key % 3 == 0, "online").when(key % 3 == 1, "offline").otherwise("store")
    master = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ngayCT"), F.col("o_orderstatus").alias("maCT"),
        F.concat(F.lit("CT"), key.cast("string")).alias("soCT"), F.col("o_orderpriority").alias("maBoPhan"),
        F.when(key % 101 != 0, order_number()).alias("maDonHang"), F.col("c_name").alias("tenKhachHang"),
        padded(F.col("c_custkey"), 9, "0").alias("soDienThoai"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("tinhThanh"),
        F.col("c_mktsegment").alias("quanHuyen"), declared.alias("sourceType"))
    document = F.to_json(F.struct(
        F.lit("test").alias("apikey"),
        F.array(F.struct(master.alias("master"), F.coalesce("detail", no_lines).alias("detail"))).alias("data")))
    payload = F.when(key % 97 == 0, F.expr("left(_doc, length(_doc) - 10)")).otherwise(F.col("_doc"))
    return orders.withColumn("_doc", document).select(
        F.concat(F.lit("B"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("batch_id"),
        key.alias("seq"), F.lit("https://api.example/import").alias("url"),
        instant("o_orderdate").alias("submitted_at"), payload.alias("payload"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_payloads(requests(spark, sf_dir))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_requests(parsed(spark, sf_dir))


# --- replies ----------------------------------------------------------------------------------

def missing_text(code: Column) -> Column:
    return F.concat(F.lit("Mã hàng "), code, F.lit(" không tồn tại trong hệ thống"))


def byte_escaped(text: str) -> str:
    """The text as some gateways return it: each UTF-8 byte beyond ASCII as ``\\xNN``."""
    return "".join(chr(b) if b < 128 else f"\\x{b:02x}" for b in text.encode("utf-8"))


def reply_body(kind: Column, code: Column, other: Column, doc: Column) -> Column:
    """Ten kinds of reply body: empty, missing codes, duplicates, other text and malformed ones."""
    said = lambda text: F.to_json(F.struct(text.alias("errorCode")))
    escaped = F.concat(F.lit(byte_escaped("Mã hàng ")), code, F.lit(byte_escaped(" không tồn tại trong hệ thống")))
    kinds = [
        F.lit("{}"), said(missing_text(code)),
        said(F.concat(missing_text(code), F.lit("; "), missing_text(other))),
        said(F.concat(F.lit("Chứng từ "), doc, F.lit(" đã nhập."))), said(F.lit("Lỗi khác")),
        F.lit("[1]"), F.lit("gateway timeout"), F.lit('{"errorCode":7}'), F.lit('{"errorCode":null}'), said(escaped)]
    chain = F.when(kind == 0, kinds[0])
    for i, body in enumerate(kinds[1:], 1):
        chain = chain.when(kind == i, body)
    return chain


def status_of_event() -> Column:
    kind = F.col("event_type")
    return (F.when(kind == "purchase", 200).when(kind == "signup", 429).when(kind == "view", 404)
            .when(kind == "click", 400).otherwise(500))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery attempt per event."""
    eid = F.col("event_id")
    body = reply_body(eid % 10, padded(eid % 2000, 6, "P"), padded(eid * 7 % 2000, 6, "P"), eid.cast("string"))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("task_id"), instant("ts").alias("attempt_at"),
        eid.alias("attempt_no"), status_of_event().alias("status_code"), body.alias("body"),
        F.lit(None).cast("string").alias("error"))


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts with their success flag by status alone, as the earlier rule counts them."""
    return attempts(spark, sf_dir).withColumn("success", ~R.classify_http("status_code"))


def order_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per order, a day after the order."""
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "P", 200).when(F.col("o_orderstatus") == "O", 404).otherwise(503)
    body = reply_body(key % 5, padded(key % 2000, 6, "P"), padded(key * 7 % 2000, 6, "P"), key.cast("string"))
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(order_number().alias("task_id"), status.alias("status_code"), body.alias("body"),
                F.concat(F.lit("HTTP "), status.cast("string"), F.lit(" error")).alias("error"),
                F.expr("cast(o_orderdate as timestamp) + interval 1 day").alias("attempt_at"), key.alias("attempt_no"))
    )


@stored
def failing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened lines of the orders whose reply is a failure, with ``pos``."""
    failing = order_replies(spark, sf_dir).where(R.classify_http("status_code"))
    return flatten_order_lines(accepted(spark, sf_dir), failing, keep=("pos",))


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_replies(spark, sf_dir).where(~R.classify_http("status_code")).withColumnRenamed("task_id", "order_id")


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger loaded without checks: status and times from the line, source type as declared."""
    lines = numbered_lines(spark, sf_dir)
    orders = (table(spark, sf_dir, "orders")
              .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")))
    key = F.col("o_orderkey")
    declared = F.when(key % 3 == 0, "online").when(key % 3 == 1, "offline").otherwise("store")
    status = F.when(F.col("l_returnflag") == "A", "needs_retry").when(F.col("l_returnflag") == "N", "completed").otherwise("cancelled")
    return lines.join(orders, F.col("l_orderkey") == key).select(
        F.when(key % 101 != 0, order_number()).alias("order_id"),
        padded(F.col("l_partkey"), 6, "P").alias("product_code"),
        F.when(F.col("l_partkey") % 7 == 0, "").when(F.col("l_partkey") % 11 == 0, None)
        .otherwise(F.concat(F.lit("IM"), F.col("line_no").cast("string"))).alias("imei"),
        declared.alias("source_type"), status.alias("status"))


def returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The returned lines with ``line_no`` and their orders; those of large orders, if there are any, never in one row."""
    if large_orders(table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL")) is None:
        every = order_lines(spark, sf_dir).select("*", F.posexplode("lines").alias("_at", "_line"))
        return every.select("*", "_line.*", (F.col("_at") + 1).cast("long").alias("line_no")).where("l_returnflag = 'R'")
    orders = (table(spark, sf_dir, "orders")
              .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")))
    return numbered_lines(spark, sf_dir).where("l_returnflag = 'R'").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


@stored
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines already known as failing: the returned ones, last touched on their ship date."""
    values = {
        "order_id": order_number(), "customer_name": F.col("c_name"),
        "product_code": padded(F.col("l_partkey"), 6, "P"),
        "product_name": F.concat(F.lit("Part "), F.col("l_partkey").cast("string")),
        "imei": item_imei(F.col("l_partkey"), F.col("line_no")),
        "quantity": F.lit(0.0), "revenue": F.lit(0), "source_type": F.lit("online"),
        "status": F.when(F.col("l_linestatus") == "F", "needs_retry").otherwise("pending"),
        "error_code": F.lit("old"), "first_failure_time": instant("l_shipdate"),
        "updated_at": F.when(F.col("l_tax") > 0, instant("l_shipdate")),
    }
    return returned_lines(spark, sf_dir).select(*[
        values.get(c, F.lit(None)).cast(LEDGER[c].dataType).alias(c) for c in LEDGER_COLUMNS])


@stored
def unique_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with one row per full key, as its uniqueness rule demands."""
    return replace_duplicates(ledger.__wrapped__(spark, sf_dir), ("first_failure_time", "status", "updated_at"))


def order_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt log of orders: each event is an attempt at order ``event_id div 3``."""
    eid = F.col("event_id")
    events = table(spark, sf_dir, "events").select(
        F.expr("event_id div 3").alias("_key"), instant("ts").alias("attempt_at"), eid.alias("attempt_no"),
        status_of_event().alias("status_code"),
        reply_body(eid % 5, padded(eid % 2000, 6, "P"), padded(eid * 7 % 2000, 6, "P"), eid.cast("string")).alias("body"))
    orders = (table(spark, sf_dir, "orders")
              .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .select(F.col("o_orderkey").alias("_key"), order_number().alias("task_id")))
    return events.join(orders, "_key").select(
        "task_id", "attempt_at", "attempt_no", "status_code", "body",
        F.concat(F.lit("HTTP "), F.col("status_code").cast("string"), F.lit(" error")).alias("error"))


# --- mapping and reconciliation ---------------------------------------------------------------

def new_code(part: Column) -> Column:
    return padded(part * 37 % 1000003, 7, "N")


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("row_no"), padded(key, 6, "P").alias("old_code"), F.col("p_name").alias("old_name"),
        F.when(key % 50 == 0, "").otherwise(new_code(key)).alias("new_code"),
        F.concat("p_name", F.lit(" v2")).alias("new_name"))


def data(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_partkey")
    new = new_code(key)
    near = F.concat(F.substring(new, 1, 7), ((F.substring(new, 8, 1).cast("int") + 1) % 10).cast("string"))
    far = F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("X"), F.substring(new, 2, 7))).otherwise(
        F.concat(F.lit("??"), F.col("l_linenumber").cast("string")))
    code = F.when(key % 4 == 0, padded(key, 6, "P")).when(key % 4 == 1, new).when(key % 4 == 2, near).otherwise(far)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", code.alias("Mã hàng"),
        F.concat(F.lit("Part "), key.cast("string")).alias("Tên hàng"))


def left(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 31 != 0, key).alias("ID"), "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")


def right(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    copies = F.when(key % 13 == 0, F.array()).when(key % 29 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (table(spark, sf_dir, "customer").withColumn("copy", F.explode(copies.cast("array<int>")))
            .select(F.when(key % 19 == 0, key + 1000000).otherwise(key).alias("ID"), "c_name",
                    F.when(key % 17 == 0, -F.col("c_acctbal")).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                    F.when(key % 23 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
                    F.concat(F.lit("copy "), F.col("copy").cast("string")).alias("note")))


# --- digests and schedules --------------------------------------------------------------------

def code_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid = F.col("event_id")
    one, two = padded(eid % 200, 6, "P"), padded(eid * 3 % 200, 6, "P")
    codes = F.when(eid % 10 == 0, F.array().cast("array<string>")).when(eid % 3 == 0, F.array(one, two)).otherwise(F.array(one))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("K"), (F.col("user_id") % 5).cast("string")).alias("key"), instant("ts").alias("ts"),
        "event_id", codes.alias("codes"))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("task_id"),
        instant("ts").alias("submitted_at"))
