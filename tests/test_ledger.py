import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators import ledger as L
from orderloom.schema import LEDGER, LEDGER_COLUMNS

T0 = dt.datetime(2024, 1, 1)
at = lambda s: T0 + dt.timedelta(seconds=s)
KEY = ("order_id", "product_code", "imei")


def row(order, product, imei, **over):
    base = dict.fromkeys(LEDGER_COLUMNS)
    base.update(order_id=order, product_code=product, imei=imei, source_type="online", status="needs_retry",
                first_failure_time=T0, updated_at=T0, quantity=1.0, revenue=Decimal("1.00"))
    base.update(over)
    return base


def frame(spark, rows, extra=""):
    schema = LEDGER.simpleString()[7:-1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER.fields) + extra
    names = [s.split()[0] for s in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def bag(rows):
    return sorted(tuple(str(r[c]) for c in LEDGER_COLUMNS) for r in rows)


def full(r):
    return all(r[k] is not None for k in KEY)


def same(a, b):
    return full(a) and full(b) and all(a[k] == b[k] for k in KEY)


def brute_insert(table, lines):
    for line in lines:
        table = [t for t in table if not same(t, line)] + [line]
    return table


def brute_update(table, lines):
    for line in lines:
        table = [{**line, "first_failure_time": t["first_failure_time"]} if same(t, line) else t for t in table]
    return table


def brute_upsert(table, lines):
    known = any(same(t, l) for t in table for l in lines)
    return (brute_update if known else brute_insert)(table, lines)


def random_line(rng, order, when, no):
    return row(order, rng.choice(["p", "q", "r", None]), rng.choice(["", "1", "2", None]), updated_at=when,
               first_failure_time=when, error_code=f"e{no}", quantity=float(rng.randrange(9)))


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_the_row_by_row_rule(spark, seed):
    rng = random.Random(seed)
    table = []
    for i in range(20):
        table = brute_insert(table, [random_line(rng, f"o{rng.randrange(9)}", at(i), i)])
    by_order = {}
    for o in range(12):
        by_order[f"o{o}"] = [{**random_line(rng, f"o{o}", at(500), n), "pos": n} for n in range(rng.randrange(1, 5))]
    lines = [l for ls in by_order.values() for l in ls]
    want = table
    for ls in by_order.values():
        want = brute_upsert(want, ls)
    orders, changes = frame(spark, table), frame(spark, lines, ", pos int")
    assert bag(r.asDict() for r in L.upsert_order(orders, changes).collect()) == bag(want)
    assert bag(r.asDict() for r in L.insert_lines(orders, changes).collect()) == bag(brute_insert(table, lines))
    assert bag(r.asDict() for r in L.update_lines(orders, changes).collect()) == bag(brute_update(table, lines))
    counts = {r.order_id: (r.n_lines, r.n_existing) for r in L.existing_lines(changes, orders).collect()}
    assert counts == {o: (len(ls), sum(any(same(t, l) for t in table) for l in ls)) for o, ls in by_order.items()}


@pytest.mark.parametrize("seed,initial", [(3, False), (4, True), (5, True)])
def test_replay_equals_the_fold_over_the_log(spark, seed, initial):
    rng = random.Random(seed)
    table = []
    if initial:
        for i in range(15):
            table = brute_insert(table, [random_line(rng, f"o{rng.randrange(6)}", at(i), i)])
    start, lines, done = list(table), [], []
    for no in range(90):
        order = "hot" if rng.random() < 0.4 else f"o{rng.randrange(8)}"
        when = at(100 + no // 2)
        if rng.random() < 0.15:
            done.append((order, when, no))
            table = [t for t in table if t["order_id"] != order]
        else:
            attempt = [{**random_line(rng, order, when, no), "pos": p, "attempt_no": no} for p in range(rng.randrange(1, 3))]
            table = brute_upsert(table, attempt)
            lines += attempt
    got = L.ledger_replay(
        frame(spark, lines, ", pos int, attempt_no long"),
        spark.createDataFrame(done, "order_id string, attempt_at timestamp, attempt_no long"),
        frame(spark, start) if initial else None)
    assert bag(r.asDict() for r in got.collect()) == bag(table)


def test_cleanup_expiry_and_violations(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    rows = [row("a", "p", "1", updated_at=at(0)), row("b", "p", "1", updated_at=at(-1)), row("c", "p", "1", updated_at=None),
            row("d", "p", "1", status="completed", updated_at=at(-99)), row("e", "p", "1", first_failure_time=None)]
    df = frame(spark, rows)
    assert sorted(r.order_id for r in L.cleanup_expired(df, now).collect()) == ["a", "c", "d", "e"]
    assert L.expired_count(df, now).first().n_expired == 1
    expired = {r.order_id: (r.age_days, r.expired) for r in L.retry_expired(df, now).collect()}
    assert expired["a"] == (2.0, True) and expired["e"] == (None, False) and "d" not in expired
    bad = frame(spark, [row(None, "p", "1"), row("x", "p", "1"), row("x", "p", "1"), row("y", "p", None), row("y", "p", None),
                        row("z", "p", "2", source_type="store", status="lost")])
    got = {(r.rule, r.order_id, r.n) for r in L.ledger_violations(bad).collect()}
    assert got == {("order_id_missing", None, 1), ("line_repeated", "x", 2), ("source_type_unknown", "z", 1), ("status_unknown", "z", 1)}


def test_registry(spark):
    events = spark.createDataFrame(
        [("A", "o1", at(0), 1), ("A", "o2", at(9), 2), ("B", "o3", at(5), 3), ("A", "o4", at(20), 4)],
        "product_code string, order_id string, detected_at timestamp, tie long")
    pick = lambda df: {r.product_code: r.order_id for r in df.collect()}
    clears = spark.createDataFrame([("A", at(9)), ("B", at(5))], "product_code string, cleared_at timestamp")
    assert pick(L.code_registry(events, "first")) == {"A": "o1", "B": "o3"}
    assert pick(L.code_registry(events, "last")) == {"A": "o4", "B": "o3"}
    assert pick(L.code_registry(events, "first", clears)) == {"A": "o4"}
    registry = L.code_registry(events, "first")
    assert pick(L.registry_clear(registry, spark.createDataFrame([("A",)], "product_code string"))) == {"B": "o3"}
    assert L.delete_delivered(frame(spark, [row("a", "p", "1"), row("b", "p", "1")]),
                              spark.createDataFrame([("a",)], "order_id string")).first().order_id == "b"


def chain_lines(order, no, keys):
    return [{**row(order, f"p{k}", "1", updated_at=at(no), first_failure_time=at(no), error_code=f"e{no}"), "pos": p, "attempt_no": no}
            for p, k in enumerate(keys)]


def test_chain_of_overlapping_attempts_takes_few_rounds(spark, monkeypatch):
    """1,000 attempts of an order, each sharing a line with the next: inserting and updating alternate."""
    made = []
    store = L.materialize
    monkeypatch.setattr(L, "materialize", lambda df, label="step": (made.append(label), store(df, label))[1])
    table, lines = [], []
    for no in range(1000):
        attempt = chain_lines("o", no, (no, no + 1))
        table = brute_upsert(table, attempt)
        lines += attempt
    got = L.ledger_replay(frame(spark, lines, ", pos int, attempt_no long"),
                          spark.createDataFrame([], "order_id string, attempt_at timestamp, attempt_no long"))
    assert bag(r.asDict() for r in got.collect()) == bag(table)
    assert made.count("replay-hops") <= 11 and made.count("replay-won") <= 2


def test_open_attempts_and_the_ledger_meet_in_one_shuffle(spark, monkeypatch):
    """Also where nothing is small enough to be broadcast: attempts, known keys and the first round need no second one."""
    made = {}
    store = L.materialize
    monkeypatch.setattr(L, "materialize", lambda df, label="step": (made.setdefault(label, []).append(df), store(df, label))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = [row("a", "p1", "1"), row("b", "p1", "1"), row(None, "p1", "1"), row("c", None, "1")]
        table, lines = list(old), []
        for no, (order, keys) in enumerate([("a", (1, 2)), ("b", (3,)), ("b", (3, 4)), ("c", (1,)), ("c", (1, 5)), ("d", (1,))]):
            attempt = chain_lines(order, no, keys)
            table = brute_upsert(table, attempt)
            lines += attempt
        got = L.ledger_replay(frame(spark, lines, ", pos int, attempt_no long"),
                              spark.createDataFrame([], "order_id string, attempt_at timestamp, attempt_no long"), frame(spark, old))
        assert bag(r.asDict() for r in got.collect()) == bag(table)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = [df for label, dfs in made.items() if label not in ("replay-lines",) for df in dfs]
    assert len(stored) == 1
    assert stored[0]._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("seed", range(3))
def test_replay_of_tangled_chains(spark, seed):
    rng = random.Random(seed)
    table, lines = [], []
    for no in range(120):
        order = rng.choice("ab")
        start = rng.randrange(50)
        attempt = chain_lines(order, no, {start + d for d in rng.choice([(0, 1), (0,), (0, 1, 2), (0, 3)])})
        table = brute_upsert(table, attempt)
        lines += attempt
    got = L.ledger_replay(frame(spark, lines, ", pos int, attempt_no long"),
                          spark.createDataFrame([], "order_id string, attempt_at timestamp, attempt_no long"))
    assert bag(r.asDict() for r in got.collect()) == bag(table)
