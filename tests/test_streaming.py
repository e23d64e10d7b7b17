import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import digest as D
from orderloom.operators import ledger as L
from orderloom.operators import replies as R
from orderloom.operators import schedule as S
from orderloom.schema import LEDGER_COLUMNS
from orderloom.streaming import jobs as J
from orderloom.streaming import processors as P
from orderloom.streaming.sinks import BucketedTable, read_stream, run_available
from tests import oracle_check as oc
from tests.test_queries import SF_DIR
from tests.test_ledger import bag, brute_insert, brute_upsert, frame, random_line, row
from tests.test_schedule import brute_spacing

T0 = dt.datetime(2024, 1, 1)
at = lambda s: T0 + dt.timedelta(seconds=s)


def arrive(spark, tmp_path, rows, schema, pieces):
    """Writes the rows, already in time order, as ``pieces`` files read one per micro-batch."""
    size = -(-len(rows) // pieces)
    folder = str(tmp_path / f"in{pieces}")
    for i in range(pieces):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
    return read_stream(spark, str(tmp_path), f"in{pieces}", files_per_batch=1)


@pytest.mark.parametrize("pieces", [1, 4])
def test_idempotent(spark, tmp_path, pieces):
    rng = random.Random(1)
    rows = sorted([(i, rng.choice("abc"), at(rng.randrange(12 * 86400))) for i in range(120)], key=lambda r: r[2])
    schema = "seq long, task_id string, submitted_at timestamp"
    got = run_available(J.stream_idempotent(arrive(spark, tmp_path, rows, schema, pieces)), "t")
    want = S.idempotent_requests(spark.createDataFrame(rows, schema))
    assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in want.collect())


def test_builtin_idempotent_never_passes_a_repeat_within_retention(spark, tmp_path):
    rows = [(0, "a", at(0)), (1, "a", at(60)), (2, "b", at(90)), (3, "a", at(86400))]
    stream = arrive(spark, tmp_path, rows, "seq long, task_id string, submitted_at timestamp", 2)
    got = run_available(J.stream_idempotent(stream, exact=False), "t").collect()
    assert sorted(r.task_id for r in got) == ["a", "b"]


@pytest.mark.parametrize("pieces", [1, 4])
def test_retry_state(spark, tmp_path, pieces):
    rng = random.Random(2)
    rows = sorted([(rng.choice("ab"), at(rng.randrange(2000)), i, rng.random() < 0.3) for i in range(80)], key=lambda r: (r[1], r[2]))
    rows.append(("end", at(9000), 99, True))
    schema = "task_id string, attempt_at timestamp, attempt_no long, success boolean"
    got = run_available(J.stream_retry_state(arrive(spark, tmp_path, rows, schema, pieces)), "t").collect()
    state, want, due = {}, {}, set()
    for task, ts, no, ok in rows:
        count, wake = state.get(task, (0, None))
        if wake is not None and wake < ts:
            due.add((task, wake))
        count = 0 if ok else count + 1
        wake = None if ok else ts + dt.timedelta(seconds=min(300, 5 * 2 ** min(count, 6)))
        state[task] = count, wake
        want[no] = ("cleared" if ok else "needs_retry", count, wake)
    due |= {(t, w) for t, (c, w) in state.items() if w}
    assert {r.attempt_no: (r.state, r.retry_count, r.next_retry_at) for r in got if r.state != "retry_due"} == want
    assert {(r.task_id, r.at) for r in got if r.state == "retry_due"} == due


def brute_digest(events):
    """Event by event with its timers, for one key."""
    day, codes, timers, scheduled, sent, out = None, set(), [], False, False, []

    def fire(until):
        nonlocal codes, scheduled, sent
        while timers and timers[0] <= until:
            when = timers.pop(0)
            if codes:
                out.append((day, when, tuple(sorted(codes))))
                codes, sent = set(), True
            scheduled = False

    for _, ts, _, cs in events:
        fire(ts)
        if cs:
            if ts.date() != day:
                day, codes, scheduled, sent = ts.date(), set(), False, False
            codes |= set(cs)
            if not sent and not scheduled:
                scheduled = True
                timers.append(ts + dt.timedelta(minutes=20))
    fire(dt.datetime.max)
    return out


@pytest.mark.parametrize("pieces", [1, 5])
def test_daily_digest(spark, tmp_path, pieces):
    rng = random.Random(4)
    times = [rng.randrange(4 * 86400) for _ in range(60)] + [86400 * d - rng.randrange(1500) for d in (1, 2, 3) for _ in range(6)]
    times += [86400 * d + rng.randrange(1500) for d in (1, 2, 3) for _ in range(6)]
    rows = [(rng.choice("ab"), at(t), i, [f"c{rng.randrange(8)}" for _ in range(rng.randrange(3))]) for i, t in enumerate(sorted(times))]
    end = [("z", at(9 * 86400), 999, [])]
    schema = "key string, ts timestamp, event_id long, codes array<string>"
    got = run_available(J.stream_daily_digest(arrive(spark, tmp_path, rows + end, schema, pieces)), "t").collect()
    sent = {}
    for r in got:
        sent.setdefault((r.key, r.digest_date, r.send_at), []).append(r.code)
    want = {(k, day, when): list(codes) for k in "ab" for day, when, codes in brute_digest([e for e in rows if e[0] == k])}
    assert {k: sorted(v) for k, v in sent.items()} == want
    assert all(r.n_codes == len(sent[r.key, r.digest_date, r.send_at]) for r in got)


def test_daily_digest_equals_batch_away_from_midnight(spark, tmp_path):
    rng = random.Random(5)
    rows = sorted([("k", at(rng.randrange(3) * 86400 + 3600 + rng.randrange(7000)), i, [f"c{rng.randrange(9)}"]) for i in range(60)], key=lambda r: r[1])
    schema = "key string, ts timestamp, event_id long, codes array<string>"
    end = [("z", at(9 * 86400), 999, [])]
    got = run_available(J.stream_daily_digest(arrive(spark, tmp_path, rows + end, schema, 3)), "t").collect()
    want = D.daily_digest(spark.createDataFrame(rows, schema)).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}


@pytest.mark.parametrize("pieces", [1, 4])
def test_debounced_digest(spark, tmp_path, pieces):
    rng = random.Random(6)
    rows = sorted([(rng.choice("ab"), at(rng.randrange(4000)), i, rng.choice([None, *"uvwxyz"])) for i in range(150)], key=lambda r: (r[1], r[2]))
    end = [("z", at(90000), 999, "q")]
    schema = "key string, ts timestamp, tie long, code string"
    got = run_available(J.stream_debounced_digest(arrive(spark, tmp_path, rows + end, schema, pieces), 300), "t").collect()
    df = spark.createDataFrame(rows, schema)
    want = D.debounced_digest(df.where("code IS NULL"), df.where("code IS NOT NULL"), 300).collect()
    assert {tuple(r) for r in got} == {tuple(r)[:4] for r in want}


@pytest.mark.parametrize("pieces", [1, 3])
def test_daily_stats(spark, tmp_path, pieces):
    rng = random.Random(7)
    rows = sorted([(at(rng.randrange(3 * 86400)), rng.random() < 0.5) for _ in range(90)])
    schema = "attempt_at timestamp, success boolean"
    got = J.run_daily_stats(arrive(spark, tmp_path, rows, schema, pieces)).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in R.daily_stats(spark.createDataFrame(rows, schema)).collect()}


@pytest.mark.parametrize("pieces", [1, 3])
def test_ledger_over_a_stream(spark, tmp_path, pieces):
    rng = random.Random(8)
    start = []
    for i in range(8):
        start = brute_insert(start, [random_line(rng, f"o{rng.randrange(4)}", at(i), i)])
    table, attempts, lines = list(start), [], []
    for no in range(24):
        order, ok = f"o{rng.randrange(4)}", rng.random() < 0.2
        attempts.append((order, at(100 + no), no, 200 if ok else 500, "{}", "e"))
        if ok:
            table = [t for t in table if t["order_id"] != order]
        else:
            mine = [{**random_line(rng, order, at(100 + no), no), "pos": p, "attempt_no": no} for p in range(2)]
            table, lines = brute_upsert(table, mine), lines + mine
    all_lines = frame(spark, lines, ", pos int, attempt_no long")
    flatten = lambda failing: all_lines.join(failing.select("attempt_no"), "attempt_no", "left_semi")
    schema = "task_id string, attempt_at timestamp, attempt_no long, status_code int, body string, error string"
    got = J.run_ledger(arrive(spark, tmp_path, attempts, schema, pieces), flatten, frame(spark, start))
    assert bag(r.asDict() for r in got.collect()) == bag(table)


def test_cleanup_on_ticks(spark, tmp_path):
    orders = frame(spark, [row("a", "p", "1", updated_at=at(0)), row("b", "p", "1", updated_at=at(2 * 86400))])
    ticks = arrive(spark, tmp_path, [(at(86400),), (at(2 * 86400 + 1),)], "now timestamp", 2)
    assert [r.order_id for r in J.run_cleanup(ticks, orders).collect()] == ["b"]


def test_retry_policy_with_pause(spark, tmp_path):
    rows = [("a", at(0), 0, None, "submitted"), ("a", at(1), 1, None, "started")]
    rows += [("a", at(2 + 86400 * i), 2 + i, False, "finished") for i in range(101)]
    schema = "task_id string, attempt_at timestamp, attempt_no long, success boolean, event string"
    got = run_available(J.stream_retry_state(arrive(spark, tmp_path, rows, schema, 1), mode="policy"), "t").collect()
    by = {r.attempt_no: r for r in got if r.state != "retry_due"}
    assert (by[0].state, by[1].state) == ("pending", "running")
    waits = [(by[2 + i].next_retry_at - by[2 + i].at).total_seconds() / 60 for i in range(99)]
    assert waits[:8] == [15, 30, 60, 120, 240, 480, 960, 1440] and set(waits[8:]) == {1440.0}
    assert by[101].state == by[102].state == "paused" and by[101].next_retry_at is None and by[101].retry_count == 100


@pytest.mark.parametrize("files", [1, 8, 64])
@pytest.mark.parametrize("name", ["stream_idempotent", "stream_retry_state", "stream_daily_digest", "stream_debounced_digest", "stream_daily_stats"])
def test_any_number_and_order_of_files(spark, tmp_path, name, files):
    """The table as one file, and as a folder of shuffled files, against its SQL."""
    source = f"{SF_DIR}/events.parquet"
    rows = spark.read.parquet(source).repartition(files, F.xxhash64("event_id"))
    target = tmp_path / "events.parquet"
    rows.write.parquet(str(target))
    assert oc.compare(spark, oc.connect(SF_DIR), str(tmp_path), name) is None


EVENTS = "key string, ts timestamp, tie long, code string"


@pytest.mark.parametrize("job, late", [
    (lambda e: J.stream_idempotent(e.selectExpr("tie seq", "key task_id", "ts submitted_at")),
     [("a", 4, at(10)), ("b", 5, at(20)), ("b", 6, at(20))]),
    (lambda e: J.stream_retry_state(e.selectExpr("key task_id", "ts attempt_at", "tie attempt_no", "false success")),
     [("a", 4, None, at(10), None, None), ("b", 5, None, at(20), None, None), ("b", 6, None, at(20), None, None)]),
    (lambda e: J.stream_daily_digest(e.selectExpr("key", "ts", "tie event_id", "filter(array(code), c -> c IS NOT NULL) codes")),
     [("a", T0.date(), at(10), 1, "x"), ("b", T0.date(), at(20), 2, "y")]),
    (lambda e: J.stream_debounced_digest(e, 300),
     [("a", at(10), None, "x"), ("b", at(20), None, "y"), ("b", at(20), None, "y")])])
def test_late_rows_are_kept_apart(spark, tmp_path, job, late):
    """A resumed stream whose later files hold earlier rows: behind the watermark of the batch before, and of the one before that."""
    root = str(tmp_path / "state")

    def run(*events):
        spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return run_available(job(read_stream(spark, str(tmp_path), "in")), "t", root=root)

    assert run(("a", at(0), 0, None), ("a", at(1), 1, "x")).late.count() == 0
    assert run(("c", at(5000), 2, "z")).late.count() == 0
    before = run(("c", at(6000), 3, "z"))
    assert before.late.count() == 0
    before = {tuple(r) for r in before.collect()}
    after = run(("a", at(10), 4, "x"), ("b", at(20), 5, "y"), ("b", at(20), 6, "y"))
    assert sorted(tuple(r) for r in after.late.collect()) == late
    assert {tuple(r) for r in after.collect()} == before and after.columns == after.late.columns and "late" not in after.columns


def test_batches_rewrite_their_buckets_only_and_go_on_after_a_stop(spark, tmp_path):
    orders = frame(spark, [row(f"o{i}", "p", "1", updated_at=at(100_000 if i % 2 else 0)) for i in range(200)])
    folder, root = tmp_path / "ticks", str(tmp_path / "state")
    tick = lambda t: spark.createDataFrame([(at(t),)], "now timestamp").coalesce(1).write.mode("append").parquet(str(folder))
    run = lambda: {r.order_id for r in J.run_cleanup(read_stream(spark, str(tmp_path), "ticks"), orders, 1, root).collect()}
    tick(50_000)
    assert len(run()) == 200
    tick(90_000)
    assert run() == {f"o{i}" for i in range(200) if i % 2}
    assert run() == {f"o{i}" for i in range(200) if i % 2}
    written = spark.read.parquet(f"{root}/written")
    assert {r.batch_id for r in written.select("batch_id").distinct().collect()} == {-1, 1}

    lines = frame(spark, [{**row("o3", "new", "9", updated_at=at(7)), "pos": 0, "attempt_no": 5}], ", pos int, attempt_no long")
    attempts = arrive(spark, tmp_path, [("o3", at(7), 5, 500, "{}", "e")],
                      "task_id string, attempt_at timestamp, attempt_no long, status_code int, body string, error string", 1)
    root = str(tmp_path / "ledger")
    got = J.run_ledger(attempts, lambda failing: lines, orders, root=root)
    assert got.count() == 201
    assert spark.read.parquet(f"{root}/written").where("batch_id >= 0").count() == 1
    assert J.run_ledger(attempts, lambda failing: lines, orders, root=root).count() == 201


def held_little(processor):
    processor.held, processor.fresh, processor.known = 40, 3, 2
    return processor


@pytest.mark.parametrize("pieces", [1, 3])
def test_one_hot_key_through_the_state_store(spark, tmp_path, pieces):
    """All rows under one key, far more than are held in memory: sorted runs, and codes as entries of the state store."""
    rng = random.Random(21)
    rows = sorted([("hot", at(rng.randrange(9000)), i, rng.choice([None, *(f"c{rng.randrange(40)}" for _ in range(4))])) for i in range(1500)],
                  key=lambda r: r[1:3])
    schema = "key string, ts timestamp, tie long, code string"
    size = -(-len(rows) // pieces)
    for i in range(pieces):  # in order from file to file, shuffled inside
        part = rows[i * size:(i + 1) * size]
        spark.createDataFrame(rng.sample(part, len(part)), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([("z", at(90000), 9999, "q")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path), "in", files_per_batch=1)
    df = spark.createDataFrame(rows, schema)

    debounced = J._fold(stream, "key", "ts", "0 seconds", {"tie": F.col("tie"), "code": F.col("code")}, held_little(P.Debounce(600 * P.MICROS)),
                        "key string, us long, position long, code string")
    want = D.debounced_digest(df.where("code IS NULL"), df.where("code IS NOT NULL"), 600).collect()
    got = run_available(debounced, "t").select("key", F.timestamp_micros("us"), "position", "code").collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r)[:4] for r in want)

    accepted = J._fold(stream, "key", "ts", "0 seconds", {"seq": F.col("tie")}, held_little(P.Accept(50 * P.MICROS)), "task_id string, seq long, us long")
    want = S.idempotent_requests(df.selectExpr("tie seq", "key task_id", "ts submitted_at"), 50).collect()
    assert {r.seq for r in run_available(accepted, "t").where("task_id = 'hot'").collect()} == {r.seq for r in want}

    tried = df.selectExpr("key task_id", "ts attempt_at", "tie attempt_no", "coalesce(code < 'c2', false) success")
    columns = {"attempt_no": F.col("tie"), "event": F.lit("finished"), "success": F.expr("coalesce(code < 'c2', false)")}
    counted = J._fold(stream, "key", "ts", "0 seconds", columns, held_little(P.Retry(lambda count: 7)),
                      "task_id string, attempt_no long, state string, us long, retry_count long, next_us long")
    want = {r.attempt_no: r.retry_count for r in S.retry_count(tried, tie="attempt_no").collect()}
    got = run_available(counted, "t").where("task_id = 'hot' AND attempt_no IS NOT NULL").collect()
    assert {r.attempt_no: r.retry_count for r in got} == want


def test_daily_stats_count_what_comes_too_late(spark, tmp_path):
    """A resumed stream whose later files hold rows of days that are over: they are reported, no more and no less, and change nothing."""
    root = str(tmp_path / "state")

    def run(*rows):
        spark.createDataFrame(rows, "attempt_at timestamp, success boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return J.run_daily_stats(read_stream(spark, str(tmp_path), "in"), root)

    day = 86400
    first = run((at(10), True), (at(20), False), (at(day + 5), True), (None, True), (at(30), None))
    assert first.late.count() == 0
    assert run((at(9 * day), True)).late.count() == 0
    found = run((at(40), True), (at(50), False), (at(60), None), (at(day + 7), False), (at(8 * day), True))
    days = {r.stat_date.day: (r.completed_tasks, r.failed_tasks) for r in found.collect()}
    assert days == {1: (1, 1), 2: (1, 0), 9: (1, 0), 10: (1, 0)}
    assert sorted(tuple(r) for r in found.late.collect()) == [
        (T0.date(), 1, 1, at(60), 3), (at(day).date(), 0, 1, at(day + 7), 1)]
    assert J.run_daily_stats(read_stream(spark, str(tmp_path), "in"), root).late.agg(F.sum("n")).first()[0] == 4


def test_retention_by_time_to_live(spark, tmp_path):
    """Equal to the batch clean-up at every tick; lines that come when they are old already go at once."""
    orders = frame(spark, [row(f"o{i % 4}", f"p{i}", None if i % 3 == 0 else str(i), updated_at=at(3600 * i)) for i in range(40)] * 2
                   + [row("n", "p", "1", updated_at=None), row("d", "p", "1", updated_at=at(0), status="completed")])
    root, lines, ticks = str(tmp_path / "state"), str(tmp_path / "rows"), str(tmp_path / "ticks")
    rows = orders.repartition(4).collect()
    for step, hours in enumerate((0, 24, 30, 61)):
        part = rows[step * 25:(step + 1) * 25]
        spark.createDataFrame(part, orders.schema).coalesce(1).write.mode("append").parquet(lines)
        spark.createDataFrame([(at(3600 * hours),)], "now timestamp").coalesce(1).write.mode("append").parquet(ticks)
        known = spark.createDataFrame(rows[:(step + 1) * 25], orders.schema)
        stream = spark.readStream.schema(orders.schema).parquet(lines)
        got = J.run_retention(stream, read_stream(spark, str(tmp_path), "ticks"), known, 1, root)
        assert bag(r.asDict() for r in got.collect()) == bag(r.asDict() for r in L.cleanup_expired(known, F.lit(at(3600 * hours)), 1).collect())
    assert got.count() < known.count()


def test_retention_keeps_few_timers(spark, tmp_path):
    """40,000 lines of two days wait in parts under few keys, each with one timer; ticks inside a day take parts of them."""
    n, (root, lines, ticks) = 40_000, (str(tmp_path / d) for d in ("state", "rows", "ticks"))
    blank = frame(spark, [row("o", "p", "1")]).drop("order_id", "updated_at")
    orders = spark.range(n).select(F.concat(F.lit("o"), F.col("id") % (n - 5)).alias("order_id"), F.timestamp_micros(
        F.unix_micros(F.lit(at(0))) + (F.col("id") % (n - 5)) * 4_000_000).alias("updated_at")).crossJoin(blank).select(*LEDGER_COLUMNS)
    orders.coalesce(3).write.parquet(lines)
    expired = []
    for step, hours in enumerate((0, 30)):
        spark.createDataFrame([(at(3600 * hours),)], "now timestamp").coalesce(1).write.mode("append").parquet(ticks)
        got = J.run_retention(spark.readStream.schema(orders.schema).parquet(lines), read_stream(spark, str(tmp_path), "ticks"), orders, 1, root)
        assert got.exceptAll(want := L.cleanup_expired(orders, F.lit(at(3600 * hours)), 1)).isEmpty() and got.count() == want.count()
        expired.append((got.expired.count(), orders.distinct().count() - want.distinct().count()))
        if not step:
            timers = spark.read.format("statestore").option("readRegisteredTimers", "true").load(f"{root}/state")
            assert 0 < timers.count() <= 2 * J.SHARDS
    assert expired[0] == (0, 0) and expired[1][0] == expired[1][1] > 0


def test_table_of_changes_against_a_dictionary(spark, tmp_path):
    """Batches of changes, deletions and growth: always the last rows of each key, as of every batch, also if a batch runs twice."""
    rng = random.Random(31)
    schema = "k string, v long"
    state = {f"k{i}": [i, -i] for i in range(60)} | {None: [7]}
    make = lambda d: spark.createDataFrame([(k, v) for k, vs in d.items() for v in vs], schema)
    table = BucketedTable(str(tmp_path / "t"), make(state), "k", bucket_rows=30)
    kept, bases = [{k: list(v) for k, v in state.items()}], 0
    for batch in range(12):
        names = {f"k{rng.randrange(90 + 20 * batch)}" for _ in range(rng.choice([1, 5, 40]))}
        new = {k: [rng.randrange(1000) for _ in range(rng.randrange(4))] for k in names}
        keys = spark.createDataFrame([(k,) for k in names], "k string")
        for _ in range(1 + (batch % 3 == 0)):  # a batch that stopped runs again
            table.write(make(new), keys, batch)
        state.update(new)
        kept.append({k: list(v) for k, v in state.items()})
    bag_of = lambda d: sorted(((k or "", v) for k, vs in d.items() for v in vs))
    for batch, want in enumerate(kept):
        assert sorted((r.k or "", r.v) for r in table.read(batch).collect()) == bag_of(want)
    some = spark.createDataFrame([("k1",), ("k5",), ("nothing",)], "k string")
    assert sorted(r.v for r in table.read(keys=some).collect()) == sorted(state["k1"] + state["k5"])
    log = spark.read.parquet(str(tmp_path / "t/written"))
    assert {r.buckets for r in log.select("buckets").distinct().collect()} >= {5, 10}  # it grew


def test_a_small_batch_writes_little(spark, tmp_path):
    """1 % of the orders: about 1 % of the bytes, and the same rows."""
    rows = spark.range(200_000).select((F.col("id") % 20_000).cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = BucketedTable(str(tmp_path / "t"), rows, "k", bucket_rows=20_000)
    keys = spark.range(200).select((F.col("id") * 97).cast("string").alias("k"))
    table.write(rows.join(keys, "k", "left_semi").withColumn("v", F.reverse("v")), keys, 0)
    size = lambda part: sum(f.stat().st_size for f in (tmp_path / "t").glob(f"*/{part}/**/*.parquet"))
    assert size("batch_id=0") < 0.03 * size("batch_id=-1")
    assert table.read().count() == 200_000 and table.read(0).exceptAll(table.read()).count() == 2_000
