"""Projections of order requests: ids, detail lines and ledger rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.scan import row_numbers
from orderloom.schema import DETAIL_TO_LEDGER, LEDGER, LEDGER_COLUMNS, MASTER_TO_LEDGER

#: Rows of hashes, of 64 each, by which documents without a reply are told before the join, whatever the number of replies.
REPLY_SLOTS = 1 << 20


def first_document() -> Column:
    return F.get("doc.data", F.lit(0))


def task_id() -> Column:
    """The order number inside the payload; NULL where the path is missing."""
    return first_document()["master"]["maDonHang"]


def task_ids(requests: DataFrame) -> DataFrame:
    return requests.withColumn("task_id", task_id())


def rejected_requests(requests: DataFrame) -> DataFrame:
    return requests.where(task_id().isNull())


def accepted_requests(requests: DataFrame) -> DataFrame:
    return task_ids(requests).where(F.col("task_id").isNotNull())


def explode_details(requests: DataFrame) -> DataFrame:
    """One row per detail item of the first document (``pos``, ``item``, ``master``).

    A request without a master or without details gives no row.
    """
    return (
        requests.withColumn("master", first_document()["master"])
        .where(F.col("master").isNotNull())
        .select("*", F.posexplode(first_document()["detail"]).alias("pos", "item"))
    )


def first_detail(requests: DataFrame) -> DataFrame:
    """Exactly one row per request, with the first detail item only.

    No ``detail`` at all leaves the item NULL; an empty ``detail``, an empty ``data`` or a missing
    master leaves both master and item NULL.
    """
    master, detail = first_document()["master"], first_document()["detail"]
    usable = master.isNotNull() & (detail.isNull() | (F.size(detail) > 0))
    return (
        requests.withColumn("master", F.when(usable, master))
        .withColumn("item", F.when(usable, F.get(detail, F.lit(0))))
        .withColumn("pos", F.lit(0))
    )


def source_type_by_slash(order_id) -> Column:
    order_id = F.col(order_id) if isinstance(order_id, str) else order_id
    return F.when(F.contains(F.coalesce(order_id, F.lit("")), F.lit("/")), "offline").otherwise("online")


def source_type_declared(declared, validate: bool = True) -> Column:
    """``validate`` also turns any value outside (online, offline) into online."""
    declared = F.col(declared) if isinstance(declared, str) else declared
    if validate:
        return F.when(declared.isin("online", "offline"), declared).otherwise("online")
    return F.coalesce(declared, F.lit("online"))


def error_code_or_error(body, error) -> Column:
    """The reply's ``errorCode`` if that key exists, even with null; else the transport error."""
    body = F.col(body) if isinstance(body, str) else body
    error = F.col(error) if isinstance(error, str) else error
    has_key = F.coalesce(F.array_contains(F.json_object_keys(body), "errorCode"), F.lit(False))
    return F.when(has_key, F.get_json_object(body, "$.errorCode")).otherwise(error)


def likely_answered(requests: DataFrame, replies: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """The requests without most of those that have no reply; those with one all stay. With ``how="left_anti"`` the others: none of them has one.

    Documents without a reply go before anything is shuffled: the hashes of the replies' ids are broadcast, 64 to a row, in at most
    ``REPLY_SLOTS`` rows. With 64 hashes to a row the table is nearly empty even with millions of replies, so few others stay.
    """
    slot = F.pmod(F.xxhash64(on), F.lit(64 * REPLY_SLOTS))
    row, bit = F.shiftright(slot, 6).alias("_row"), (slot % 64).cast("int").alias("_bit")
    marked = replies.select(row, bit).groupBy("_row").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    hit = (F.col("_row") == F.col("_marked")) & F.expr("shiftrightunsigned(_bits, _bit) & 1L = 1L")
    return requests.select("*", row, bit).join(F.broadcast(marked.withColumnRenamed("_row", "_marked")), hit, how).drop("_row", "_bit")


def flatten_order_lines(requests: DataFrame, responses: DataFrame, details: str = "all", source: str = "slash",
                        on: str = "task_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The 21 ledger columns for every line of every request that has a failing response.

    ``requests`` are parsed and carry ``task_id``; ``responses`` carry ``task_id, body, error,
    attempt_at``. ``details`` is all|first, ``source`` is slash|declared|declared_checked.
    ``keep`` names further columns (such as ``pos``) to hand through.
    """
    replies = responses.select(
        F.col("task_id").alias(on), *[c for c in responses.columns if c in ("attempt_at", "attempt_no")],
        error_code_or_error("body", "error").alias("error_code"))
    likely = likely_answered(requests.drop("payload"), replies, on)
    # Documents meet their reply before they unfold into lines. Parsed documents are many times
    # their stored size, so the join must not choose to broadcast them by that size.
    answered = likely.join(replies.hint("merge"), on)
    joined = {"all": explode_details, "first": first_detail}[details](answered)
    order_no = F.col("master.maDonHang")
    declared = F.col("master.sourceType")
    source_type = {
        "slash": source_type_by_slash(order_no),
        "declared": source_type_declared(declared, validate=False),
        "declared_checked": source_type_declared(declared),
    }[source]
    values = {
        "order_id": F.col(on),
        **{col: F.col(f"master.{field}") for field, col in MASTER_TO_LEDGER.items()},
        **{col: F.col(f"item.{field}") for field, col in DETAIL_TO_LEDGER.items()},
        "source_type": source_type,
        "status": F.lit("needs_retry"),
        "error_code": F.col("error_code"),
        "first_failure_time": F.col("attempt_at"),
        "updated_at": F.col("attempt_at"),
    }
    return joined.select(
        *[values[c].try_cast(LEDGER[c].dataType).alias(c) for c in LEDGER_COLUMNS], *keep)


def batch_summary(requests: DataFrame, page: int = 1000) -> DataFrame:
    """Per batch the number of tasks and their ids in order, in pages of at most ``page`` ids.

    Numbering runs over ordered chunks, so a huge batch is never gathered in one task and no row
    grows beyond a page.
    """
    ids = task_ids(requests).where(F.col("task_id").isNotNull()).select("batch_id", "seq", "task_id")
    numbered = row_numbers(ids, ["batch_id"], ["seq", "task_id"], "_n")
    pages = (
        numbered.groupBy("batch_id", F.floor((F.col("_n") - 1) / page).cast("long").alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("_n", "task_id"))).alias("_ids"))
        .withColumn("task_ids", F.transform("_ids", lambda s: s["task_id"]))
    )
    totals = ids.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_tasks"))
    return pages.join(totals, "batch_id").select("batch_id", "page", "n_tasks", "task_ids")
