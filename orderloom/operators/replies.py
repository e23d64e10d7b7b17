"""Classification of delivery replies, and what is counted from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import (
    codes_in_order, extract_missing_codes, is_duplicate_document, repair_escapes,
)

# Status codes that count as a failed delivery, and those never retried (fixed values).
FAILING = (400, 401, 403, 404, 500, 502, 503, 504)
TERMINAL = (400, 401, 403, 404)
TRANSPORT = 0


def classify_http(status) -> Column:
    """True for a failure. Everything not listed is a success, also 301, 408, 429 and 501."""
    status = F.col(status) if isinstance(status, str) else status
    return status.isin(TRANSPORT, *FAILING)


def normalize_reply(attempts: DataFrame, empty_body: str = "object") -> DataFrame:
    """Adds ``status`` and ``reply`` (a JSON object text) and settles ``error``.

    A transport error, a body that is not JSON or not an object gives status 0 and ``{}``. An
    empty body is ``{}``; with ``empty_body='strict'`` an empty success body is an error as well.
    """
    body = F.coalesce("body", F.lit(""))
    shape = F.schema_of_variant(F.try_parse_json(body))
    raised = F.coalesce(F.col("status_code"), F.lit(TRANSPORT)) == TRANSPORT
    empty = body == ""
    if empty_body == "strict":
        broken_empty = empty & ~F.col("status_code").isin(*FAILING)
    else:
        broken_empty = F.lit(False)
    staged = attempts.withColumn("_shape", F.when(~empty & ~raised, F.coalesce(shape, F.lit("BAD"))))
    not_object = F.coalesce(~F.col("_shape").startswith("OBJECT"), F.lit(False))
    invalid = ~raised & (broken_empty | not_object)
    lost = raised | invalid
    return (
        staged
        .withColumn("status", F.when(lost, TRANSPORT).otherwise(F.col("status_code")))
        .withColumn("reply", F.when(lost | empty, "{}").otherwise(F.col("body")))
        .withColumn("error", F.when(invalid, "reply is not a JSON object")
                    .when(lost, F.coalesce("error", F.lit("transport error")))
                    .when(F.col("status_code").isin(*FAILING),
                          F.concat(F.lit("HTTP "), F.col("status_code").cast("string"), F.lit(" error"))))
        .drop("_shape")
    )


def _with_error_code(normalized: DataFrame) -> DataFrame:
    """``_text`` and ``_kind`` of errorCode for failing replies; ``_falsy`` when it says nothing."""
    code = F.try_variant_get(F.try_parse_json("reply"), F.lit("$.errorCode"), "variant")
    staged = (normalized
              .withColumn("_failed", classify_http("status"))
              .withColumn("_code", F.when(F.col("_failed"), code))
              .withColumn("_kind", F.schema_of_variant("_code"))
              .withColumn("_text", F.try_variant_get("_code", F.lit("$"), "string"))
              .drop("_code"))
    text = F.coalesce("_text", F.lit(""))
    empty_value = text.isin("false", "[]", "{}") | F.coalesce(text.try_cast("double") == 0, F.lit(False))
    is_text = F.coalesce(F.col("_kind") == "STRING", F.lit(False))
    return (staged.withColumn("_is_text", is_text)
            .withColumn("_falsy", (text == "") | (~is_text & empty_value)))


def outcome_v2(attempts: DataFrame) -> DataFrame:
    """Full decision per attempt: ``outcome, success, retry, error, error_text, missing_codes``.

    First match wins: completed, completed_unconfirmed (a failing reply that names no error is
    not retried), retry_malformed, duplicate_success, retry_missing_code, terminal, retry_server.
    Store the result before filtering it: a filter on the outcome would be pushed below the
    classification together with a copy of it.
    """
    staged = _with_error_code(normalize_reply(attempts))
    said = F.col("_failed") & ~F.col("_falsy") & F.col("_is_text")
    staged = staged.withColumn("error_text", F.when(said, repair_escapes("_text")))
    staged = (staged.withColumn("_duplicate", F.coalesce(is_duplicate_document("error_text"), F.lit(False)))
              .withColumn("missing_codes", F.when(
                  ~F.col("_duplicate"), extract_missing_codes("error_text"))))
    outcome = (
        F.when(~F.col("_failed"), "completed")
        .when(F.col("_falsy"), "completed_unconfirmed")
        .when(~F.col("_is_text"), "retry_malformed")
        .when(F.col("_duplicate"), "duplicate_success")
        .when(F.size("missing_codes") > 0, "retry_missing_code")
        .when(F.col("status").isin(*TERMINAL), "terminal")
        .otherwise("retry_server")
    )
    return (
        staged.withColumn("outcome", outcome)
        .withColumn("success", F.col("outcome").isin("completed", "duplicate_success"))
        .withColumn("retry", F.col("outcome").startswith("retry_"))
        .withColumn("error", F.when(F.col("_duplicate"), F.concat(
            F.lit("Duplicate document detected: "), F.col("error_text"))).otherwise(F.col("error")))
        .withColumn("missing_codes", F.coalesce("missing_codes", F.array().cast("array<string>")))
        .drop("_failed", "_kind", "_text", "_is_text", "_falsy", "_duplicate")
    )


def outcome_simple(attempts: DataFrame) -> DataFrame:
    """Earlier rule: success or needs_retry, nothing is terminal.

    Codes come from the text as received, in order of appearance; the stored status text is the
    repaired one.
    """
    staged = _with_error_code(normalize_reply(attempts, empty_body="strict"))
    said = F.col("_failed") & ~F.col("_falsy")
    raw = F.when(said & F.col("_is_text"), F.col("_text"))
    return (
        staged
        .withColumn("outcome", F.when(F.col("_failed"), "needs_retry").otherwise("success"))
        .withColumn("success", ~F.col("_failed"))
        .withColumn("error_text", F.when(said, F.coalesce(repair_escapes(raw), F.col("_text"))))
        .withColumn("missing_codes", F.coalesce(
            F.array_distinct(codes_in_order(raw)), F.array().cast("array<string>")))
        .drop("_failed", "_kind", "_text", "_is_text", "_falsy")
    )


def daily_stats(attempts: DataFrame, at: str = "attempt_at") -> DataFrame:
    """Completed and failed tasks per date, from a ``success BOOLEAN`` column."""
    return attempts.groupBy(F.to_date(at).alias("stat_date")).agg(
        F.count_if(F.col("success")).alias("completed_tasks"),
        F.count_if(~F.col("success")).alias("failed_tasks"),
        F.max(at).alias("last_updated"),
    )


def code_events(attempts: DataFrame) -> DataFrame:
    """One row per reported code of an attempt that has ``missing_codes``.

    The outer form plus a filter: the plain form would push "array not empty" down below the
    classification and evaluate all of that twice.
    """
    return (attempts.select("*", F.explode_outer("missing_codes").alias("product_code"))
            .where("product_code IS NOT NULL").drop("missing_codes"))


def distinct_codes(attempts: DataFrame) -> DataFrame:
    return code_events(attempts).select("product_code").distinct().orderBy("product_code")


def missing_code_report(codes: DataFrame, now: Column) -> DataFrame:
    # Column titles and texts of the report (fixed values).
    return codes.select(
        F.col("product_code").alias("Product Code"),
        F.lit("Not Found").alias("Status"),
        F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias("Detected At"),
        F.lit("Verify & Add to System").alias("Action Required"),
    )
