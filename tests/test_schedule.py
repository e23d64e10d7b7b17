import bisect
import datetime as dt
import random

from pyspark.sql import functions as F

from orderloom.functions.backoff import backoff_seconds, policy_offsets_minutes
from orderloom.operators import digest, scan, schedule

T0 = dt.datetime(2024, 1, 1)
at = lambda s: T0 + dt.timedelta(seconds=s)


def test_backoff(spark):
    df = spark.range(1, 9).select(backoff_seconds("id").alias("e"), backoff_seconds("id", "constant").alias("c"))
    assert [r.e for r in df.collect()] == [10, 20, 40, 80, 160, 300, 300, 300]
    assert {r.c for r in df.collect()} == {300}


def test_retry_schedule(spark):
    assert policy_offsets_minutes()[:9] == [0, 15, 45, 105, 225, 465, 945, 1905, 3345]
    rows = schedule.retry_schedule(spark.createDataFrame([("a", T0)], "task_id string, first_failure_time timestamp")).orderBy("attempt").collect()
    assert len(rows) == 100 and rows[1].attempt_at == at(900) and rows[-1].next_state == "paused"
    assert {r.next_state for r in rows[:-1]} == {"retry"}


def brute_throttle(arrivals, gap):
    out, last = [], float("-inf")
    for a in arrivals:
        last = max(a, last) + gap
        out.append(last)
    return out


def test_throttle_matches_the_recursion_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}", at(rng.randrange(900))) for i in range(500)]
    df = spark.createDataFrame(rows, "seq long, k string, submitted_at timestamp")
    for key in ("k", None):
        for width in (1, 7):
            got = {r.seq: r.dispatch_at for r in schedule.throttle_schedule(df, key, 2, width=width).collect()}
            groups = {}
            for seq, k, ts in rows:
                groups.setdefault(k if key else 0, []).append((ts, seq))
            for group in groups.values():
                group.sort()
                want = brute_throttle([(t - T0).total_seconds() for t, _ in group], 2)
                assert [got[s] for _, s in group] == [at(w) for w in want]
    small = spark.createDataFrame([(i, "x", at(s)) for i, s in enumerate((0, 0, 1, 100))], "seq long, k string, submitted_at timestamp")
    assert sorted(r.dispatch_at for r in schedule.throttle_schedule(small).collect()) == [at(s) for s in (2, 4, 6, 102)]


def brute_spacing(times, gap):
    kept = []
    for t in sorted(times):
        if not kept or t - kept[-1] >= gap:
            kept.append(t)
    return kept


def test_greedy_spacing(spark):
    rng = random.Random(5)
    for gap, spread, n in ((10, 200, 60), (50, 400, 300), (3, 2000, 80), (1, 40, 100)):
        rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(3)}", rng.randrange(spread)) for _ in range(n)]
        got = scan.greedy_spacing(spark.createDataFrame(rows, "k string, t long"), ["k"], "t", gap, width=5).collect()
        want = [(k, t) for k in {k for k, _ in rows} for t in brute_spacing([x for kk, x in rows if kk == k], gap)]
        assert sorted((r.k, r.t) for r in got) == sorted(want)


def test_idempotent_requests(spark):
    rows = [(0, "a", at(0)), (1, "a", at(0)), (2, "a", at(86400)), (3, "a", at(172800)), (4, "a", at(172801)), (5, "b", at(5)), (6, None, at(1))]
    got = schedule.idempotent_requests(spark.createDataFrame(rows, "seq long, task_id string, submitted_at timestamp"))
    assert sorted(r.seq for r in got.collect()) == [0, 3, 5]


def test_retry_count_and_status(spark):
    rng = random.Random(8)
    rows = [(i, "hot" if rng.random() < 0.5 else f"t{rng.randrange(5)}", at(rng.randrange(300)), rng.random() < 0.2) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, task_id string, attempt_at timestamp, success boolean")
    got = {r.seq: r.retry_count for r in schedule.retry_count(df, width=6).collect()}
    state, want = {}, {}
    for seq, task, ts, ok in sorted(rows, key=lambda r: (r[2], r[0])):
        state[task] = 0 if ok else state.get(task, 0) + 1
        want[seq] = state[task]
    assert got == want
    full = df.withColumn("status_code", F.lit(500)).withColumn("body", F.col("seq").cast("string")).withColumn("error", F.lit(None).cast("string"))
    status = {r.task_id: r.retry_count for r in schedule.task_status(full).collect()}
    assert status == {t: n for t, n in state.items() if n}


def test_manual_retries_count_twice(spark):
    rows = [(0, "t", at(0), False, False), (1, "t", at(1), False, True), (2, "u", at(0), False, True), (3, "u", at(5), True, True)]
    df = spark.createDataFrame(rows, "seq long, task_id string, attempt_at timestamp, success boolean, by_hand boolean")
    assert {r.seq: r.retry_count for r in schedule.retry_count(df, manual="by_hand").collect()} == {0: 1, 1: 3, 2: 2, 3: 0}
    full = df.withColumn("status_code", F.lit(500)).withColumn("body", F.lit("")).withColumn("error", F.lit(""))
    assert [(r.task_id, r.retry_count) for r in schedule.task_status(full, manual="by_hand").collect()] == [("t", 3)]


def test_next_mark(spark):
    rng = random.Random(9)
    events = [("k", rng.randrange(100), i) for i in range(80)]
    marks = [("k", rng.randrange(100)) for _ in range(12)]
    e = spark.createDataFrame(events, "k string, t long, i long")
    m = spark.createDataFrame(marks, "k string, t long")
    for inclusive in (True, False):
        got = {r.i: r.n for r in scan.next_mark(e, m, ["k"], "t", "n", inclusive, width=5).collect()}
        want = {i: min((x for _, x in marks if x > t or (inclusive and x == t)), default=None) for _, t, i in events}
        assert got == want


def brute_status(events):
    day, codes, opened, out = {}, {}, {}, {}
    for key, ts, eid, cs in sorted(events, key=lambda e: (e[1], e[2])):
        if not cs:
            out[eid] = ("no_codes", 0)
            continue
        if day.get(key) != ts.date():
            day[key], codes[key], opened[key] = ts.date(), set(), None
            sent = False
            state = codes, opened
            brute_status.sent = getattr(brute_status, "sent", {})
            brute_status.sent[key] = False
        if opened[key] and not brute_status.sent[key] and ts >= opened[key] + dt.timedelta(minutes=20):
            brute_status.sent[key] = True
            codes[key] = set()
        codes[key] |= set(cs)
        if brute_status.sent[key]:
            out[eid] = ("accumulated_no_email", len(codes[key]))
        elif opened[key]:
            out[eid] = ("accumulating", len(codes[key]))
        else:
            opened[key] = ts
            out[eid] = ("scheduled", len(codes[key]))
    return out


def test_digest_batch_forms(spark):
    rng = random.Random(11)
    events = []
    for i in range(300):
        ts = at(rng.randrange(3 * 86400) if rng.random() < 0.5 else rng.randrange(3) * 86400 + rng.randrange(3000))
        events.append((rng.choice("ab"), ts, i, [f"c{rng.randrange(12)}" for _ in range(rng.randrange(4))]))
    df = spark.createDataFrame(events, "key string, ts timestamp, event_id long, codes array<string>")
    got = {r.event_id: (r.status, r.accumulated_count) for r in digest.digest_event_status(df).collect()}
    assert got == brute_status(events)
    want = set()
    for key in "ab":
        for d in {e[1].date() for e in events}:
            today = [e for e in events if e[0] == key and e[1].date() == d and e[3]]
            if today:
                send = min(e[1] for e in today) + dt.timedelta(minutes=20)
                codes = {c for e in today if e[1] < send for c in e[3]}
                want |= {(key, d, send, len(codes), c) for c in codes}
    assert {tuple(r) for r in digest.daily_digest(df).collect()} == want


def test_debounced_digest(spark):
    rng = random.Random(12)
    submits = [(rng.choice("ab"), at(rng.randrange(4000))) for _ in range(60)]
    codes = [(rng.choice("ab"), at(rng.randrange(4500)), i, f"c{rng.randrange(9)}") for i in range(120)]
    got = digest.debounced_digest(spark.createDataFrame(submits, "key string, ts timestamp"),
                                  spark.createDataFrame(codes, "key string, ts timestamp, tie long, code string"), 300)
    want = set()
    for key in "ab":
        ends, waiting = brute_spacing([int((t - T0).total_seconds()) for k, t in submits if k == key], 300), []
        for end in [o + 300 for o in ends]:
            start = max([o + 300 for o in ends if o + 300 < end], default=-1)
            seen = []
            for _, ts, tie, c in sorted((c for c in codes if c[0] == key), key=lambda c: (c[1], c[2])):
                if start <= (ts - T0).total_seconds() < end and c not in seen:
                    seen.append(c)
            want |= {(key, at(end), i, c) for i, c in enumerate(seen, 1)}
    assert {tuple(r)[:4] for r in got.collect()} == want


def test_one_key_with_all_rows(spark):
    """120,000 rows of one key in two chunks: right, and without a frame that is evaluated anew for every row."""
    rng = random.Random(13)
    times = [rng.randrange(3_000_000) for _ in range(60_000)]
    marks = sorted(rng.randrange(3_000_000) for _ in range(60_000))
    e = spark.createDataFrame([("k", t, i) for i, t in enumerate(times)], "k string, t long, i long")
    m = spark.createDataFrame([("k", t) for t in marks], "k string, t long")
    found = scan.next_mark(e, m, ["k"], "t", "n", width=2)
    assert "currentrow$(),unboundedfollowing$()" not in found._jdf.queryExecution().toString().lower().replace(" ", "")
    got = {r.i: r.n for r in found.collect()}
    want = {}
    for i, t in enumerate(times):
        j = bisect.bisect_left(marks, t)
        want[i] = marks[j] if j < len(marks) else None
    assert got == want
    kept = scan.greedy_spacing(m, ["k"], "t", 700, width=2).collect()
    assert sorted(r.t for r in kept) == brute_spacing(marks, 700)
