"""The ledger of failing order lines and the registry of missing codes.

Every change is a pure function from the old table and the changes to the new table. Two lines
are the same line if order, product code and imei are equal and none of them is NULL.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.schema import LEDGER_COLUMNS, LINE_KEY
from orderloom.session import materialize, shuffle_width

RETENTION_DAYS = 2
_DAY_MICROS = 86_400_000_000
KEPT_ON_UPDATE = (*LINE_KEY, "first_failure_time")
# Allowed values (fixed values of the table rules).
SOURCE_TYPES = ("online", "offline")
STATUSES = ("pending", "running", "needs_retry", "completed")


def _has_key() -> Column:
    return F.col("order_id").isNotNull() & F.col("product_code").isNotNull() & F.col("imei").isNotNull()


def _by_order(rows: DataFrame) -> DataFrame:
    """Rows with a full key, dealt by their order: its lines stand together, so what they have in common shrinks in the shuffle. The number of
    tasks is fixed, since merging tasks by their shrunk size would make them too large to sort in memory."""
    return rows.repartition(shuffle_width(rows.sparkSession), "order_id")


def ledger_violations(orders: DataFrame) -> DataFrame:
    """Rows that break a rule of the ledger: ``rule, order_id, product_code, imei, n``."""
    # All rules are counted per key at once, so the table is read and shuffled once.
    counted = orders.groupBy(*LINE_KEY).agg(
        F.count(F.lit(1)).alias("_lines"), F.count_if(~F.col("source_type").isin(*SOURCE_TYPES)).alias("_source"),
        F.count_if(~F.col("status").isin(*STATUSES)).alias("_status"))

    def broken(rule: str, holds: Column, n: str) -> Column:
        return F.when(holds, F.struct(F.lit(rule).alias("rule"), F.col(n).alias("n")))

    rules = F.array_compact(F.array(
        broken("order_id_missing", F.col("order_id").isNull(), "_lines"), broken("source_type_unknown", F.col("_source") > 0, "_source"),
        broken("status_unknown", F.col("_status") > 0, "_status"), broken("line_repeated", _has_key() & (F.col("_lines") > 1), "_lines")))
    return counted.select(F.explode(rules).alias("_broken"), *LINE_KEY).select("_broken.rule", *LINE_KEY, "_broken.n")


def replace_duplicates(lines: DataFrame, order: tuple[str, ...] = ("updated_at", "pos")) -> DataFrame:
    """The last line per key; lines with a NULL key part all stay."""
    values = [c for c in lines.columns if c not in LINE_KEY]
    last = (_by_order(lines.where(_has_key())).groupBy(*LINE_KEY)
            .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_row")).select(*LINE_KEY, "_row.*"))
    return last.select(*lines.columns).unionByName(lines.where(~_has_key()))


def _ledger(df: DataFrame) -> DataFrame:
    return df.select(*LEDGER_COLUMNS)


def insert_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Append the lines of newly failing orders, replacing rows with the same key."""
    new = _ledger(replace_duplicates(materialize(lines, "insert-lines")))
    return (_ledger(orders).join(new.where(_has_key()).select(*LINE_KEY), [*LINE_KEY], "left_anti")
            .select(*LEDGER_COLUMNS).unionByName(new))


def update_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Overwrite matching rows but for their first failure time; unmatched lines are lost."""
    # Both sides go by their order and meet in a window over the key, so each is shuffled once; a join would deal them anew by the whole key.
    values = [c for c in LEDGER_COLUMNS if c not in KEPT_ON_UPDATE]
    both = (_ledger(orders).where(_has_key()).withColumn("_line", F.lit(False))
            .unionByName(lines.where(_has_key()).select(*LEDGER_COLUMNS, "pos", F.lit(True).alias("_line")), allowMissingColumns=True))
    new = F.max_by(F.struct(*values), F.when(F.col("_line"), F.struct("updated_at", "pos"))).over(Window.partitionBy(*LINE_KEY))
    keyed = _by_order(both).withColumn("_new", new).where("NOT _line").select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in LEDGER_COLUMNS])
    return keyed.unionByName(_ledger(orders.where(~_has_key())))


def _known_keys(orders: DataFrame) -> DataFrame:
    return orders.where(_has_key()).select(*LINE_KEY).distinct()


def existing_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per order of the request: its lines, and how many of them the ledger already holds."""
    flagged = lines.join(_known_keys(orders).withColumn("_known", F.lit(True)), [*LINE_KEY], "left")
    return flagged.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count("_known").alias("n_existing"))


def upsert_order(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """If any line of an order is known, update all its lines, else insert them all.

    ``lines`` holds one failing request per order; use ``ledger_replay`` for several.
    """
    lines = materialize(lines, "upsert-lines")
    known = (lines.where(_has_key()).join(_known_keys(orders), [*LINE_KEY], "left_semi")
             .select("order_id").distinct().withColumn("_known", F.lit(True)))
    routed = materialize(lines.join(known, "order_id", "left"), "upsert-routed")
    updated = update_lines(orders, routed.where("_known"))
    # None of these lines has a row to replace, else its order would be known.
    return updated.unionByName(_ledger(replace_duplicates(routed.where("_known IS NULL").drop("_known"))))


def delete_delivered(orders: DataFrame, delivered: DataFrame) -> DataFrame:
    return orders.join(delivered.select("order_id").distinct(), "order_id", "left_anti").select(*orders.columns)


def registry_clear(registry: DataFrame, delivered: DataFrame) -> DataFrame:
    """Drop the product codes that the delivered requests carry in their first line."""
    return registry.join(delivered.select("product_code").distinct(), "product_code", "left_anti").select(
        *registry.columns)


def expired_rows(now: Column, days: int = RETENTION_DAYS) -> Column:
    old = F.unix_micros("updated_at") < F.unix_micros(now) - F.lit(days * _DAY_MICROS)
    return F.coalesce((F.col("status") == "needs_retry") & old, F.lit(False))


def cleanup_expired(orders: DataFrame, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return orders.where(~expired_rows(now, days))


def expired_count(orders: DataFrame, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    return orders.where(expired_rows(now, days)).agg(F.count(F.lit(1)).alias("n_expired"))


def retry_expired(orders: DataFrame, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Age of each retrying order since its first failure, and whether its retry window is over."""
    age = (F.unix_micros(now) - F.unix_micros("_first")) / F.lit(float(_DAY_MICROS))
    return (orders.where("status = 'needs_retry'").groupBy("order_id")
            .agg(F.min("first_failure_time").alias("_first"))
            .select("order_id", age.alias("age_days"), F.coalesce(age >= days, F.lit(False)).alias("expired")))


def code_registry(events: DataFrame, mode: str = "first", clears: DataFrame | None = None) -> DataFrame:
    """``product_code, detected_at, order_id`` from (product_code, order_id, detected_at, tie) events.

    ``first`` keeps the first sighting, ``last`` the latest. ``clears`` (product_code, cleared_at)
    are deliveries: only events after the code's last clear count.
    """
    if clears is not None:
        last = clears.groupBy("product_code").agg(F.max("cleared_at").alias("_cleared"))
        events = (events.join(last, "product_code", "left")
                  .where("_cleared IS NULL OR detected_at > _cleared").drop("_cleared"))
    pick = {"first": F.min, "last": F.max}[mode]
    return (events.groupBy("product_code")
            .agg(pick(F.struct("detected_at", "tie", "order_id")).alias("_e"))
            .select("product_code", "_e.detected_at", "_e.order_id"))


# --- whole log --------------------------------------------------------------------------------

def _last_deliveries(deliveries: DataFrame) -> DataFrame:
    return (deliveries.groupBy("order_id")
            .agg(F.max(F.struct(F.col("attempt_at").alias("at"), F.col("attempt_no").alias("no"))).alias("_ok")))


def after_last_delivery(attempts: DataFrame, deliveries: DataFrame) -> DataFrame:
    """The attempts (task_id, attempt_at, attempt_no, ...) that no later delivery of their order makes void.

    To be used before attempts unfold into lines: a replay forgets all others.
    """
    done = _last_deliveries(deliveries).withColumnRenamed("order_id", "task_id")
    seq = F.struct(F.col("attempt_at").alias("at"), F.col("attempt_no").alias("no"))
    return attempts.join(done, "task_id", "left").where(F.col("_ok").isNull() | (seq > F.col("_ok"))).drop("_ok")


def _chains(touches: DataFrame) -> DataFrame:
    """Of open attempts (line key and seq), those that insert as far as chains tell.

    An attempt that waits for one earlier attempt only inserts if that one doesn't. Along a chain of such attempts inserting and not
    inserting alternate from its head, so pointer doubling finds each attempt's head and whether its distance is even: log2(length)
    joins on (order, attempt). Heads that wait for several attempts, and what hangs on them, stay open.
    """
    key, one = [*LINE_KEY], ["order_id", "seq"]
    firsts = touches.groupBy(*key).agg(F.min("seq").alias("_first"))
    placed = materialize(touches.join(firsts, key), "replay-firsts")
    seconds = placed.where("seq > _first").groupBy(*key).agg(F.min("seq").alias("_second"))
    waits = F.when(F.col("seq") > F.col("_first"), F.col("_first"))
    step = materialize(
        placed.join(seconds, key, "left").groupBy(*one)
        .agg(F.min(waits).alias("_to"), (F.max(F.coalesce(F.col("seq") > F.col("_second"), F.lit(False)))
                                         | F.coalesce(F.min(waits) < F.max(waits), F.lit(False))).alias("_several")), "replay-waits")
    # a winner and an attempt that waits for several are heads: they point at themselves
    hop = step.select(*one, F.when(F.col("_several") | F.col("_to").isNull(), F.col("seq")).otherwise(F.col("_to")).alias("_to"),
                      (~F.col("_several") & F.col("_to").isNotNull()).alias("_odd"))
    while True:
        onward = hop.select("order_id", F.col("seq").alias("_to"), F.col("_to").alias("_to2"), F.col("_odd").alias("_odd2"))
        further = materialize(hop.join(onward, ["order_id", "_to"]).select(
            *one, F.col("_to2").alias("_to"), (F.col("_odd") != F.col("_odd2")).alias("_odd"),
            (F.col("_to2") != F.col("_to")).alias("_moved")), "replay-hops")
        hop = further.drop("_moved")
        if further.where("_moved").isEmpty():
            break
    heads = step.where("NOT _several AND _to IS NULL").select("order_id", F.col("seq").alias("_to"))
    won = hop.where("NOT _odd").join(heads, ["order_id", "_to"], "left_semi").select(*one)
    return materialize(touches.join(won, one, "left_semi").select(*key, "seq"), "replay-won")


def _decided(touches: DataFrame) -> DataFrame:
    """Open attempts (line key and seq), dealt by their order: ``_won`` if it is the earliest for all its keys, ``_settled`` if it shares a key
    with one that is. All windows are within the order, so nothing is dealt anew."""
    by_key, by_attempt = Window.partitionBy(*LINE_KEY), Window.partitionBy("order_id", "seq")
    return (touches.withColumn("_first", F.col("seq") == F.min("seq").over(by_key)).withColumn("_won", F.min("_first").over(by_attempt))
            .withColumn("_taken", F.max("_won").over(by_key)).withColumn("_settled", F.max("_taken").over(by_attempt))
            .select(*LINE_KEY, "seq", "_won", "_settled"))


def _replayed(keyed: DataFrame, last_ok: DataFrame, owned: DataFrame, orders: DataFrame | None) -> DataFrame:
    """Rows with the values of the last attempt that names their key: those of ``orders`` without a delivery, and the inserted ones (``owned``).

    Old rows, attempted lines, inserts and deliveries go by their order and meet in windows, so each is shuffled once.
    """
    values = [c for c in LEDGER_COLUMNS if c not in KEPT_ON_UPDATE]
    sides = [keyed.select(*LEDGER_COLUMNS, "seq", "pos", F.lit("line").alias("_side")),
             last_ok.select("order_id", F.lit("delivery").alias("_side")),
             owned.select(*LINE_KEY, F.col("seq.at").alias("first_failure_time"), F.lit("insert").alias("_side"))]
    if orders is not None:
        sides.append(_ledger(orders.where("order_id IS NOT NULL")).withColumn("_side", F.lit("row")))
    every = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    new = F.max_by(F.struct(*values), F.when(F.col("_side") == "line", F.struct("seq", "pos"))).over(Window.partitionBy(*LINE_KEY))
    delivered = F.max(F.col("_side") == "delivery").over(Window.partitionBy("order_id"))
    return (_by_order(every).withColumn("_new", new).withColumn("_delivered", delivered)
            .where("_side = 'insert' OR (_side = 'row' AND NOT _delivered)").select(*[
                F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
                for c in LEDGER_COLUMNS]))


def ledger_replay(lines: DataFrame, deliveries: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """The ledger after a log of failures and deliveries, as if applied one by one in time order.

    ``lines`` are the ledger columns of every line of every failing attempt plus ``attempt_no`` (a
    tie-break for equal times) and ``pos``; ``deliveries`` are (order_id, attempt_at, attempt_no).

    An attempt inserts if none of its keys is known by then, else it updates. So the attempts that
    insert are found in rounds: one that is the earliest open attempt for all its keys inserts,
    and every other open attempt that shares a key with it updates. Retries repeat their payload,
    so one round settles nearly everything. Attempts that overlap in a chain are settled together (``_chains``); only attempts that wait for
    several open ones take further rounds. A key's row then takes its values from the last
    attempt that names it. Ledger keys and attempts meet by their order in one shuffle, sorted in one task; no order's log is ever
    gathered in one row.
    """
    seq = F.struct(F.col("updated_at").alias("at"), F.col("attempt_no").alias("no"))
    last_ok = _last_deliveries(deliveries)
    # ``_renewed``: the order was delivered before this attempt, so that it had no rows then
    live = (lines.withColumn("seq", seq).join(last_ok, "order_id", "left")
            .where("_ok IS NULL OR seq > _ok").withColumn("_renewed", F.col("_ok").isNotNull()).drop("_ok"))
    live = materialize(live, "replay-lines")
    key = [*LINE_KEY]
    keyed = live.where(_has_key())

    touches = keyed.select(*key, "seq", "_renewed")
    if orders is None:
        touches = _by_order(touches)
    else:
        known = F.max(F.col("_old")).over(Window.partitionBy(*key))
        updates = F.max(F.col("_known") & ~F.col("_renewed")).over(Window.partitionBy("order_id", "seq"))
        both = touches.withColumn("_old", F.lit(False)).unionByName(
            orders.where(_has_key()).select(*key, F.lit(True).alias("_old")), allowMissingColumns=True)
        touches = (_by_order(both).withColumn("_known", known).where("NOT _old").withColumn("_updates", updates).where("NOT _updates"))

    inserts = []

    def settle(won: DataFrame, open_: DataFrame) -> DataFrame:
        """What is open after these attempts inserted: all that share a key with them are decided."""
        inserts.append(won)
        settled = open_.join(won.select(*key), key, "left_semi").select("order_id", "seq").distinct()
        return materialize(open_.join(settled, ["order_id", "seq"], "left_anti"), "replay-open")

    while True:
        decided = materialize(_decided(touches.select(*key, "seq").distinct()), "replay-round")
        inserts.append(decided.where("_won").select(*key, "seq"))
        touches = decided.where("NOT _settled").select(*key, "seq")
        if touches.isEmpty():
            break
        touches = settle(_chains(touches), touches)
        if touches.isEmpty():
            break
        touches = _by_order(touches)

    owned = functools.reduce(DataFrame.unionByName, inserts)
    parts = [_replayed(keyed, last_ok, owned, orders)]
    if orders is not None:
        parts.append(_ledger(orders.where("order_id IS NULL")))  # no attempt and no delivery names them

    # Lines without a full key: kept whenever their attempt inserted.
    with_key = keyed.select("order_id", "seq").distinct().join(owned.select("order_id", "seq").distinct(), ["order_id", "seq"], "left_anti")
    parts.append(live.where(~_has_key()).join(with_key, ["order_id", "seq"], "left_anti").select(*LEDGER_COLUMNS))
    return functools.reduce(DataFrame.unionByName, parts)
