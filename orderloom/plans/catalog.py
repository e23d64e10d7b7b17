"""One query per operator, each over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import text as X
from orderloom.functions import backoff as B
from orderloom.operators import digest as D
from orderloom.operators import ledger as L
from orderloom.operators import mapping as M
from orderloom.operators import orders as O
from orderloom.operators import reconcile as C
from orderloom.operators import replies as R
from orderloom.operators import schedule as S
from orderloom.plans import inputs as I
from orderloom.session import fresh_path
from orderloom.sources import tables as TB
from orderloom.sources import payloads as PL
from orderloom.streaming import jobs as J
from orderloom.streaming.sinks import read_stream, run_available

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result columns as text, numbers and booleans only, so that any client compares them alike."""
    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        return c.alias(f.name)
    return df.select(*[shown(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


# --- sources, sinks, checks -------------------------------------------------------------------

@query
def parse_payloads(spark, d):
    first = O.first_document()
    return I.parsed(spark, d).select(
        "seq", F.col("_corrupt").alias("corrupt"), F.col("doc.apikey").alias("apikey"),
        first["master"]["soCT"].alias("document_number"), first["master"]["tenKhachHang"].alias("customer_name"),
        F.size(first["detail"]).cast("long").alias("n_details"),
        F.get(first["detail"], F.lit(0))["soLuong"].alias("first_quantity"))


@query
def read_string_table(spark, d):
    return TB.read_string_table(spark, f"{d}/part.parquet", fill_blank=True)


@query
def read_inferred_table(spark, d):
    path = TB.write_csv(I.table(spark, d, "customer"), fresh_path(spark, "customer") + ".csv")
    return TB.read_inferred_table(spark, path, "csv")


@query
def write_diffs(spark, d):
    a, b = I.left(spark, d), I.right(spark, d)
    paths = TB.write_diffs(C.keys_only_left(a, b, "ID"), C.keys_only_right(a, b, "ID"),
                           C.value_differences(a, b, "ID"), fresh_path(spark, "diffs"))
    back = {n: TB.read_string_table(spark, p, fmt="csv") for n, p in paths.items()}
    show = lambda n, key, text: back[n].select(F.lit(n).alias("part"), F.col(key).alias("key"), F.col(text).alias("text"))
    return (show("only_left", "ID", "c_name").unionByName(show("only_right", "ID", "c_name"))
            .unionByName(show("value_differences", "Key", "Column")))


@query
def write_mapped(spark, d):
    mapped = M.map_exact(I.data(spark, d), I.mapping(spark, d))
    path = TB.write_mapped(mapped, fresh_path(spark, "mapped"))
    return spark.read.parquet(path)


@query
def ledger_violations(spark, d):
    return L.ledger_violations(I.raw_ledger(spark, d))


@query
def missing_code_report(spark, d):
    return R.missing_code_report(R.distinct_codes(R.outcome_v2(I.attempts(spark, d))), I.now())


# --- projections ------------------------------------------------------------------------------

@query
def task_ids(spark, d):
    return O.task_ids(I.parsed(spark, d)).select("batch_id", "seq", "task_id")


@query
def rejected_requests(spark, d):
    return O.rejected_requests(I.parsed(spark, d)).select("batch_id", "seq", F.col("_corrupt").alias("corrupt"))


def _item():
    return [F.col("master.tenKhachHang").alias("customer_name"), F.col("item.maHang").alias("product_code"),
            F.col("item.imei").alias("imei"), F.col("item.soLuong").try_cast("double").alias("quantity")]


@query
def explode_details(spark, d):
    return O.explode_details(I.accepted(spark, d)).select("task_id", "pos", *_item())


@query
def first_detail(spark, d):
    return O.first_detail(I.accepted(spark, d)).select("task_id", *_item())


@query
def flatten_order_lines(spark, d):
    return O.flatten_order_lines(I.accepted(spark, d), I.order_replies(spark, d))


@query
def source_type_by_slash(spark, d):
    return O.task_ids(I.parsed(spark, d)).select("seq", O.source_type_by_slash("task_id").alias("source_type"))


@query
def source_type_declared(spark, d):
    declared = O.first_document()["master"]["sourceType"]
    return I.parsed(spark, d).where("NOT _corrupt").select(
        "seq", O.source_type_declared(declared).alias("checked"),
        O.source_type_declared(declared, validate=False).alias("as_declared"))


@query
def error_code_or_error(spark, d):
    return R.normalize_reply(I.attempts(spark, d)).select(
        "attempt_no", O.error_code_or_error("reply", "error").alias("error_code"))


@query
def column_profile(spark, d):
    return C.column_profile(I.left(spark, d), I.right(spark, d))


@query
def summary(spark, d):
    return C.summary(I.left(spark, d), I.right(spark, d), "ID")


# --- scalars ----------------------------------------------------------------------------------

def _error_text(spark, d):
    return I.attempts(spark, d).select("attempt_no", F.get_json_object("body", "$.errorCode").alias("text"))


@query
def repair_escapes(spark, d):
    return _error_text(spark, d).select("attempt_no", X.repair_escapes("text").alias("text"))


@query
def extract_missing_codes(spark, d):
    return _error_text(spark, d).select("attempt_no", X.extract_missing_codes("text").alias("codes"))


@query
def is_duplicate_document(spark, d):
    return _error_text(spark, d).select("attempt_no", X.is_duplicate_document("text").alias("duplicate"))


@query
def normalize_header(spark, d):
    headed = F.concat(F.lit("Mã Hàng Gốc/"), F.col("p_name"), F.lit(" Đơn-Vị: "), F.col("p_type"))
    return I.table(spark, d, "part").select("p_partkey", X.normalize_header(headed).alias("header"))


def _code_pairs(spark, d):
    data = I.data(spark, d).select("l_orderkey", F.col("`Mã hàng`").alias("code"), F.expr(
        "cast(substring(`Tên hàng`, 6) as long)").alias("part"))
    codes = I.mapping(spark, d).select(F.col("row_no").alias("part"), "new_code")
    return data.select("part", "code").distinct().join(codes, "part")


@query
def edit_distance(spark, d):
    return _code_pairs(spark, d).select("code", "new_code", X.edit_distance("code", "new_code").alias("distance"))


@query
def similarity(spark, d):
    return _code_pairs(spark, d).select("code", "new_code", X.similarity("code", "new_code").alias("similarity"))


@query
def backoff_seconds(spark, d):
    counted = S.retry_count(I.decided(spark, d), tie="attempt_no").where("NOT success")
    return counted.select("attempt_no", "retry_count", B.backoff_seconds("retry_count").alias("exponential"),
                          B.backoff_seconds("retry_count", "constant").alias("constant"))


@query
def retry_schedule(spark, d):
    firsts = (I.decided(spark, d).where("NOT success").groupBy("task_id")
              .agg(F.min("attempt_at").alias("first_failure_time")))
    return S.retry_schedule(firsts)


@query
def retry_expired(spark, d):
    return L.retry_expired(I.ledger(spark, d), I.now())


# --- replies ----------------------------------------------------------------------------------

@query
def classify_http(spark, d):
    return I.attempts(spark, d).select("attempt_no", "status_code", R.classify_http("status_code").alias("failed"))


@query
def normalize_reply(spark, d):
    both = lambda df: df.select("attempt_no", "status", "reply", "error")
    return both(R.normalize_reply(I.attempts(spark, d)))


@query
def outcome_v2(spark, d):
    return R.outcome_v2(I.attempts(spark, d)).select(
        "attempt_no", "status", "outcome", "success", "retry", "error", "error_text", "missing_codes")


@query
def outcome_simple(spark, d):
    return R.outcome_simple(I.attempts(spark, d)).select(
        "attempt_no", "status", "outcome", "success", "error", "error_text", "missing_codes")


# --- joins ------------------------------------------------------------------------------------

@query
def map_exact(spark, d):
    return M.map_exact(I.data(spark, d), I.mapping(spark, d))


@query
def map_reverse(spark, d):
    mapping = I.mapping(spark, d)
    return M.map_reverse(M.map_exact(I.data(spark, d), mapping), mapping)


@query
def map_fuzzy(spark, d):
    return M.best_matches(I.data(spark, d).select(F.col("`Mã hàng`").alias("code")), I.mapping(spark, d))


@query
def apply_mapping(spark, d):
    return M.apply_mapping(I.data(spark, d), I.mapping(spark, d))


@query
def keys_only_left(spark, d):
    return C.keys_only_left(I.left(spark, d), I.right(spark, d), "ID")


@query
def keys_only_right(spark, d):
    return C.keys_only_right(I.left(spark, d), I.right(spark, d), "ID")


@query
def common_keys(spark, d):
    return C.common_keys(I.left(spark, d), I.right(spark, d), "ID")


@query
def value_differences(spark, d):
    return C.value_differences(I.left(spark, d), I.right(spark, d), "ID")


@query
def frequency_differences(spark, d):
    return C.frequency_differences(I.left(spark, d), I.right(spark, d), "ID")


@query
def existing_lines(spark, d):
    return L.existing_lines(I.failing_lines(spark, d), I.ledger(spark, d))


# --- aggregations -----------------------------------------------------------------------------

@query
def value_counts(spark, d):
    return C.value_counts(I.right(spark, d), "ID")


@query
def distinct_key_count(spark, d):
    return C.distinct_key_count(I.right(spark, d), "ID")


@query
def distinct_keys_by_day(spark, d):
    """Sketches of an event's user per day and event type, merged per day, held against the exact count: within four standard errors."""
    events = I.table(spark, d, "events").select(F.to_date(I.instant("ts")).alias("day"), "event_type", "user_id")
    per_type = C.key_sketches(events, "user_id", ["day", "event_type"])
    exact = events.groupBy("day").agg(F.countDistinct("user_id").alias("n_exact"))
    off = F.abs(F.col("n_keys") - F.col("n_exact")) <= 4 * C.sketch_error() * F.col("n_exact")
    return C.sketched_key_count(per_type, ["day"]).join(exact, "day").select("day", "n_exact", off.alias("within_error"))


@query
def null_profile(spark, d):
    return C.null_profile(I.left(spark, d), "ID")


@query
def daily_stats(spark, d):
    return R.daily_stats(I.decided(spark, d))


@query
def distinct_codes(spark, d):
    return R.distinct_codes(R.outcome_v2(I.attempts(spark, d)))


@query
def mapping_stats(spark, d):
    return M.mapping_stats(I.data(spark, d), I.mapping(spark, d))


@query
def batch_summary(spark, d):
    return O.batch_summary(I.parsed(spark, d))


@query
def expired_count(spark, d):
    return L.expired_count(I.ledger(spark, d), I.now())


# --- windows, duplicates, order, sets ---------------------------------------------------------

@query
def last_wins(spark, d):
    named = I.mapping(spark, d)
    return M.last_wins(named, "old_name", ["old_code", "new_code"])


@query
def replace_duplicates(spark, d):
    return L.replace_duplicates(I.failing_lines(spark, d))


@query
def code_registry(spark, d):
    return L.code_registry(_sightings(spark, d), "first", _clears(spark, d))


@query
def code_registry_last(spark, d):
    return L.code_registry(_sightings(spark, d), "last")


def _sightings(spark, d):
    seen = R.code_events(R.outcome_simple(I.attempts(spark, d)))
    return seen.select("product_code", F.col("task_id").alias("order_id"), F.col("attempt_at").alias("detected_at"),
                       F.col("attempt_no").alias("tie"))


def _clears(spark, d):
    return I.decided(spark, d).where("success").select(
        I.padded(F.col("attempt_no") * 13 % 2000, 6, "P").alias("product_code"), F.col("attempt_at").alias("cleared_at"))


@query
def retry_count(spark, d):
    return S.retry_count(I.decided(spark, d), tie="attempt_no").select("task_id", "attempt_no", "success", "retry_count")


@query
def task_status(spark, d):
    return S.task_status(I.decided(spark, d), tie="attempt_no")


@query
def throttle_schedule(spark, d):
    return S.throttle_schedule(I.submissions(spark, d), "task_id", 6 * 3600)


@query
def throttle_schedule_global(spark, d):
    return S.throttle_schedule(I.submissions(spark, d), None, 5 * 60)


@query
def idempotent_requests(spark, d):
    return S.idempotent_requests(I.submissions(spark, d))


@query
def frequency_top(spark, d):
    return C.frequency_top(I.left(spark, d), I.right(spark, d), "ID", 20)


@query
def sample_keys(spark, d):
    return C.sample_keys(I.left(spark, d), I.right(spark, d), "ID", 5)


@query
def preview(spark, d):
    shown = C.preview(I.left(spark, d), I.right(spark, d), ["ID", "c_name"], 3)
    return shown.withColumn("c_nationkey", F.col("c_nationkey").cast("long"))


@query
def key_set_ops(spark, d):
    return C.key_set_ops(I.left(spark, d), I.right(spark, d), "ID")


# --- table changes ----------------------------------------------------------------------------

@query
def insert_lines(spark, d):
    return L.insert_lines(I.unique_ledger(spark, d), I.failing_lines(spark, d))


@query
def update_lines(spark, d):
    return L.update_lines(I.unique_ledger(spark, d), I.failing_lines(spark, d))


@query
def upsert_order(spark, d):
    return L.upsert_order(I.unique_ledger(spark, d), I.failing_lines(spark, d))


@query
def delete_delivered(spark, d):
    return L.delete_delivered(I.ledger(spark, d), I.delivered(spark, d))


@query
def registry_clear(spark, d):
    registry = L.code_registry(_sightings(spark, d), "first")
    first = O.first_detail(I.accepted(spark, d)).select(
        F.col("task_id").alias("order_id"), F.col("item.maHang").alias("product_code"))
    done = first.join(I.delivered(spark, d).select("order_id"), "order_id", "left_semi")
    return L.registry_clear(registry, done)


@query
def cleanup_expired(spark, d):
    return L.cleanup_expired(I.ledger(spark, d), I.now())


def _flatten_attempts(requests):
    return lambda failing: O.flatten_order_lines(requests, failing, keep=("pos", "attempt_no"))


@query
def ledger_replay(spark, d):
    log = I.order_attempts(spark, d)
    failed = R.classify_http("status_code")
    done = log.where(~failed).select(F.col("task_id").alias("order_id"), "attempt_at", "attempt_no")
    lines = _flatten_attempts(I.accepted(spark, d))(L.after_last_delivery(log.where(failed), done))
    return L.ledger_replay(lines, done, I.unique_ledger(spark, d))


# --- streams ----------------------------------------------------------------------------------

def _event_stream(spark, d):
    return read_stream(spark, d, "events.parquet")


@query
def stream_requests(spark, d):
    """Requests as they arrive, one JSON line each, to the detail lines of those that are accepted."""
    folder = fresh_path(spark, "requests")
    I.requests(spark, d).write.option("compression", "gzip").json(folder)
    lines = O.explode_details(O.accepted_requests(PL.parse_payloads(PL.read_request_stream(spark, folder))))
    return run_available(lines.select("task_id", "pos", *_item()), "request-lines")


@query
def stream_idempotent(spark, d):
    arriving = _event_stream(spark, d).select(
        F.col("event_id").alias("seq"), F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("task_id"),
        I.instant("ts").alias("submitted_at"))
    return run_available(J.stream_idempotent(arriving), "idempotent")


def _attempt_stream(spark, d):
    return _event_stream(spark, d).select(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("task_id"), I.instant("ts").alias("attempt_at"),
        F.col("event_id").alias("attempt_no"), (~R.classify_http(I.status_of_event())).alias("success"))


@query
def stream_retry_state(spark, d):
    return run_available(J.stream_retry_state(_attempt_stream(spark, d)), "retry-state")


@query
def daily_digest(spark, d):
    return D.daily_digest(I.code_events(spark, d))


@query
def stream_daily_digest(spark, d):
    eid = F.col("event_id")
    one, two = I.padded(eid % 200, 6, "P"), I.padded(eid * 3 % 200, 6, "P")
    codes = F.when(eid % 10 == 0, F.array().cast("array<string>")).when(eid % 3 == 0, F.array(one, two)).otherwise(F.array(one))
    arriving = _event_stream(spark, d).select(
        F.concat(F.lit("K"), (F.col("user_id") % 5).cast("string")).alias("key"), I.instant("ts").alias("ts"),
        "event_id", codes.alias("codes"))
    return run_available(J.stream_daily_digest(arriving), "digest")


@query
def digest_event_status(spark, d):
    return D.digest_event_status(I.code_events(spark, d))


def _submits_and_codes(spark, d):
    events = I.code_events(spark, d)
    return events.select("key", "ts"), events.select("key", "ts", F.col("event_id").alias("tie"), F.explode("codes").alias("code"))


@query
def debounced_digest(spark, d):
    return D.debounced_digest(*_submits_and_codes(spark, d), 600)


@query
def stream_debounced_digest(spark, d):
    eid = F.col("event_id")
    code = F.when(eid % 2 == 0, I.padded(eid % 200, 6, "P"))
    arriving = _event_stream(spark, d).select(
        F.concat(F.lit("K"), (F.col("user_id") % 5).cast("string")).alias("key"), I.instant("ts").alias("ts"),
        eid.alias("tie"), code.alias("code"))
    return run_available(J.stream_debounced_digest(arriving, 600), "debounced")


@query
def stream_daily_stats(spark, d):
    return J.run_daily_stats(_attempt_stream(spark, d))


def _order_attempt_stream(spark, d):
    """The order attempts as a stream: events joined with the order numbers, a stored table."""
    eid = F.col("event_id")
    status = I.status_of_event()
    orders = (I.table(spark, d, "orders").join(I.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .select(F.col("o_orderkey").alias("_key"), I.order_number().alias("task_id")))
    return _event_stream(spark, d).select(
        F.expr("event_id div 3").alias("_key"), I.instant("ts").alias("attempt_at"), eid.alias("attempt_no"),
        status.alias("status_code"),
        I.reply_body(eid % 5, I.padded(eid % 2000, 6, "P"), I.padded(eid * 7 % 2000, 6, "P"), eid.cast("string")).alias("body"),
        F.concat(F.lit("HTTP "), status.cast("string"), F.lit(" error")).alias("error")).join(orders, "_key").drop("_key")


@query
def stream_ledger(spark, d):
    return J.run_ledger(_order_attempt_stream(spark, d), _flatten_attempts(I.accepted(spark, d)), I.unique_ledger(spark, d))


@query
def stream_cleanup(spark, d):
    # The clock ticks with the order dates, so that it passes through the ledger's whole time.
    ticks = read_stream(spark, d, "orders.parquet").select(I.instant("o_orderdate").alias("now"))
    return J.run_cleanup(ticks, I.ledger(spark, d))


@query
def stream_retention(spark, d):
    """The same by time to live: ledger rows as a stream of files, each an entry of the state store until it expires."""
    orders = I.ledger(spark, d)
    folder = fresh_path(spark, "ledger-rows")
    orders.write.parquet(folder)
    lines = spark.readStream.schema(orders.schema).parquet(folder)
    ticks = read_stream(spark, d, "orders.parquet").select(I.instant("o_orderdate").alias("now"))
    return J.run_retention(lines, ticks, orders)
