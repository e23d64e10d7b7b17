"""Toxicity, decontamination, nearest neighbours and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import decontaminate, packing, permutation_index, simhash, suffix_array, toxicity
from orderloom.llm.queries import REGISTRY, tokenizer_path
from tests.llm.conftest import make, rows, words

SF = "/root/testdata/sf0.01"


def all_tags(model, ws):
    """Marginals of tag 1 by summing over all taggings."""
    total, ones = 0.0, np.zeros(len(ws))
    step = model.step()
    for code in range(1 << len(ws)):
        tags = [code >> i & 1 for i in range(len(ws))]
        weight, before = 1.0, 0
        for w, t in zip(ws, tags):
            weight *= step[before, t] * (np.exp(model.emission(w) or 0.0) if t else 1.0)
            before = t
        total += weight
        ones += weight * np.array(tags)
    return ones / total


def test_marginals_against_all_taggings():
    model = toxicity.Model({"=bad": 2.0, "^ugl": 1.5, "=meh": -0.5}, -1.2, 0.4, -0.3, True)
    powers = toxicity.Powers(model.step())
    rng = random.Random(1)
    for _ in range(30):
        ws = [rng.choice(["bad", "ugly", "meh", "fine", "ok"]) for _ in range(rng.randrange(1, 10))]
        at = [i for i, w in enumerate(ws) if model.emission(w) is not None]
        if at:
            got = toxicity.marginals(model, powers, len(ws), at, [model.emission(ws[i]) for i in at])
            assert np.allclose(got, all_tags(model, ws)[at])


def test_gradient():
    rng = random.Random(2)
    docs = [(20, [(i, (rng.randrange(3),)) for i in sorted(rng.sample(range(20), 4))], bool(d % 2)) for d in range(6)] + [(15, [], False)]
    data = {}
    real = toxicity._likelihood

    def spy(theta, d, l2):
        data["d"] = d
        return real(theta, d, l2)

    toxicity._likelihood = spy
    try:
        toxicity.fit(docs, 3, rounds=1)
    finally:
        toxicity._likelihood = real
    theta = np.array([0.5, -0.2, 0.8, -1.0, 0.3, -0.4])
    _, g = real(theta, data["d"], 1e-3)
    for i in range(6):
        step = np.zeros(6)
        step[i] = 1e-5
        slope = (real(theta + step, data["d"], 1e-3)[0] - real(theta - step, data["d"], 1e-3)[0]) / 2e-5
        assert abs(slope - g[i]) < 1e-3


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    pairs, labels = [], []
    for i in range(400):
        t = words(rng, 60, 200).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                t[rng.randrange(1, 60)] = rng.choice(["Vile", "vileness", "rotten"])
            t[0] = "Vile"
        pairs.append((i, " ".join(t)))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (3, None, None), (1, 0, 0)]
    return make(spark, [*pairs, (None, "vile"), (1000, None), (1001, "")]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(labelled):
    got = {r["doc_id"]: r for r in toxicity.toxicity(*labelled).collect()}
    assert len(got) == 403
    for i in range(400):
        assert got[i]["predicted"] == int(i % 5 == 0)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i]["score"] <= 1 and bool(got[i]["spans"]) == (i % 5 == 0)
    assert got[1000]["predicted"] == got[1001]["predicted"] == 0
    text = {r["doc_id"]: r["text"] for r in labelled[0].collect()}
    for s in got[0]["spans"]:
        assert all(w.lower() in ("vile", "vileness", "rotten") for w in text[0][s["start"]:s["end"]].split())


def test_repeated_documents_train_once(labelled):
    docs, labels = labelled
    rows_of = toxicity._sample(docs, labels, 50, 100).collect()
    once = {r["doc_id"]: r["text"] for r in rows_of}
    assert len(rows_of) == len(once)
    hot = min(i for i, t in once.items() if "Vile" in t)
    copies = docs.where(F.col("doc_id") == hot).withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("_")
    many = docs.unionByName(copies).unionByName(copies.limit(3).withColumn("text", F.lit(None).cast("string")))
    sample = toxicity._sample(many, labels, 50, 100).collect()
    assert len(sample) == len(once) and {r["doc_id"]: r["text"] for r in sample} == once
    other = docs.unionByName(copies.withColumn("text", F.lit("neutral words")))
    got = {tuple(sorted(r["text"] for r in toxicity._sample(d, labels, 50, 100).collect() if r["doc_id"] == hot)) for d in (other, other.repartition(7))}
    assert len(got) == 1 and len(next(iter(got))) == 1
    one, two = toxicity.train(docs, labels), toxicity.train(many, labels)
    assert vars(one) == vars(two)


def test_toxicity_of_very_long_texts(labelled):
    """The whole of a text counts: its last words, after 300,000 clean ones, as well as all of them."""
    rng = random.Random(9)
    clean = words(rng, 300_000)
    docs = make(labelled[0].sparkSession, [(5000, clean), (5001, clean + " vile"), (5002, "vile " * 100_000), (5003, "x" * 2_000_000)])
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs.unionByName(labelled[0]), labelled[1]).where("doc_id >= 5000").collect()}
    assert {d: r["predicted"] for d, r in got.items()} == {5000: 0, 5001: 1, 5002: 1, 5003: 0}
    assert [s["start"] for s in got[5001]["spans"]][-1] >= len(clean)


def test_toxicity_without_labels(odd, empty, labelled):
    nothing = labelled[1].where("false")
    assert {r["score"] for r in toxicity.toxicity(odd, nothing).collect()} == {0.0}
    assert toxicity.toxicity(empty, labelled[1]).count() == 0


def test_held_out_accuracy(spark):
    """Some labels of this table are set by chance, which bounds what can be reached."""
    folder = "/root/testdata/sf0.1"
    r = REGISTRY["op3_toxicity"](spark, folder).toPandas()
    y = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    m = r[r.held_out].merge(y, on="doc_id")
    assert (m.predicted == m.toxic).mean() >= 0.97
    assert (m.predicted[m.toxic == 0] == 0).mean() >= 0.99


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def test_masks_see_every_two_substitutions():
    rng = random.Random(1)
    item = decontaminate.word_values(ITEM.encode())[:10]
    for a in range(10):
        for b in range(a):
            doc = item.copy()
            doc[[a, b]] = [rng.getrandbits(63), rng.getrandbits(63)]
            hit = any((decontaminate.mask_hashes(item, m, i) == decontaminate.mask_hashes(doc, m, i)).any() for i, m in enumerate(decontaminate.MASKS))
            assert hit and decontaminate.aligned_leaks(doc, item, 0)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(0, ITEM), (1, "seven short words make one whole item"), (2, "too few words"), (3, None), (None, ""), (4, ITEM)],
                                 "item_id long, text string")


def test_leaks(spark, bench, odd, empty):
    rng = random.Random(4)
    w = ITEM.split()
    changed = " ".join("other" if i in (3, 9) else x for i, x in enumerate(w))
    apart = " ".join("other" if i % 3 == 0 else x for i, x in enumerate(w))
    pairs = [(0, words(rng, 30) + " " + ITEM.upper() + ", " + words(rng, 9)), (1, changed), (2, apart), (3, " ".join(w[:9])), (4, " ".join(w[2:13])),
             (5, words(rng, 50) + " Seven short words; make one whole item! end"), (6, "seven short words make one item"), (7, "too few words"),
             (8, words(rng, 400)), (9, None), (None, ITEM), (10, " ".join(reversed(w)))]
    got = rows(decontaminate.leaks(make(spark, pairs), bench), "doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal")
    of = {(d, i): tuple(x) for d, i, *x in got}
    assert {d for d, _ in of} == {0, 1, 4, 5, None}
    assert of[0, 0] == of[0, 4] == (30, 0, 16, 16) and of[1, 0] == (0, 0, 16, 14) and of[4, 0] == (0, 2, 11, 11) and of[5, 1] == (50, 0, 7, 7)
    kept = decontaminate.without_leaks(make(spark, pairs), bench)
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 6, 7, 8, 9, 10}
    assert decontaminate.leaks(empty, bench).count() == decontaminate.leaks(odd, bench.where("false")).count() == 0
    assert decontaminate.without_leaks(odd, bench).count() == odd.count()


def brute_leaks(doc, item):
    """Every alignment, every window: (doc word, item word, words, equal words) of each leaked stretch."""
    width = min(10, len(item))
    most = 2 if len(item) >= 10 else 1
    if width < 5:
        return set()
    out = set()
    for shift in range(-len(item), len(doc)):
        inside = set()
        for i in range(len(item) - width + 1):
            places = range(i, i + width)
            if all(0 <= j + shift < len(doc) for j in places) and sum(item[j] != doc[j + shift] for j in places) <= most:
                inside |= set(places)
        for i in sorted(inside):
            if i - 1 not in inside:
                end = i
                while end in inside:
                    end += 1
                equal = [j for j in range(i, end) if item[j] == doc[j + shift]]
                out.add((equal[0] + shift, equal[0], equal[-1] + 1 - equal[0], len(equal)))
    return out


def test_leaks_against_all_alignments(spark):
    """Random items and documents made of their stretches, with words replaced, dropped and added, and repeated many times."""
    rng = random.Random(8)
    items = [(i, [f"t{rng.randrange(60)}" for _ in range(rng.choice([3, 5, 7, 9, 10, 11, 25, 60]))]) for i in range(25)]
    docs = []
    for d in range(60):
        text = []
        for _ in range(rng.randrange(1, 6)):
            item = rng.choice(items)[1]
            a = rng.randrange(len(item))
            part = [f"z{rng.randrange(9)}" if rng.random() < 0.12 else w for w in item[a:a + rng.randrange(4, 40)]]
            if len(part) > 12 and rng.random() < 0.3:
                del part[rng.randrange(len(part))]
            text += part + [f"t{rng.randrange(60)}" for _ in range(rng.randrange(4))]
        docs.append((d, text))
    docs.append((60, (items[-1][1] + ["between"]) * 40))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = rows(decontaminate.leaks(make(spark, [(d, " ".join(w)) for d, w in docs]), bench), "doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal")
    want = {(d, i, *leak) for d, w in docs for i, item in items for leak in brute_leaks(w, item)}
    assert len(want) > 100 and set(got) == want and len(got) == len(want)


def test_short_items_with_one_substitution(spark):
    items = {n: [f"s{n}x{i}" for i in range(n)] for n in range(4, 10)}
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    pairs, want = [], set()
    for n, w in items.items():
        for a in range(n):
            pairs.append((100 * n + a, "before it " + " ".join("other" if i == a else x for i, x in enumerate(w)) + " after"))
            want |= {(100 * n + a, n, n - 1)} if n >= 5 else set()
        pairs.append((100 * n + 50, " ".join(w)))
        want |= {(100 * n + 50, n, n)} if n >= 5 else set()
        pairs.append((100 * n + 60, " ".join("other" if i in (1, n - 1) else x for i, x in enumerate(w)) + " end"))
    assert set(rows(decontaminate.leaks(make(spark, pairs), bench), "doc_id", "item_id", "n_equal")) == want


def test_nearest(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 24))
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(3000, None), (3050, [0.0] * 24), (3100, [float("nan")] * 24), (3150, [None] * 24), (None, x[0].tolist()),
                                                        (3200, x[0].tolist()), (3250, [1.0, 2.0]), (0, x[0].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = permutation_index.nearest(df, least=150, shard_rows=1000, query_rows=20).toPandas()
    ids = np.append(np.arange(3000), 3200)
    unit = np.vstack([x, x[:1]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hit = 0
    queries = [i for i in ids if i % 50 == 0]
    for q in queries:
        s = unit @ unit[q if q < 3000 else 0]
        s[ids == q] = -9
        want = ids[np.lexsort((ids, -s))][:5]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
        assert np.allclose(mine.score, s[np.searchsorted(ids, mine.vec_id)], atol=1e-12) and (np.diff(mine.score) <= 0).all()
        hit += len(set(want) & set(mine.vec_id))
    assert sorted(set(got.query_id)) == queries and hit / (5 * len(queries)) >= 0.9
    assert permutation_index.nearest(df.where("false")).count() == 0


def test_nearest_with_clashing_columns(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 4)).round(3).tolist()
    plain = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")
    clash = plain.select("*", *[F.lit("x").alias(c) for c in ("id", "v", "dim", "ids", "shard", "part", "place", "query_id", "query", "rank", "score")])
    assert rows(permutation_index.nearest(clash), "query_id", "rank", "vec_id", "score") == rows(
        permutation_index.nearest(plain), "query_id", "rank", "vec_id", "score")


def test_nearest_with_copies(spark):
    """A third of the rows hold one vector, which is more than a shard ranks again; another id has many vectors near one query."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 24))
    x[:, 0] += 3
    same = np.sort(rng.permutation(3000)[:1000])
    x[same] = x[same[0]]
    x[same, 5] = 0.0
    near = x[same[0]] + 0.01 * rng.normal(size=24)
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(3050, near.tolist())]
    data = [(i, [-0.0 if c == 0 and i % 2 else c for c in v]) for i, v in data]
    alone = np.zeros(24)
    alone[1] = -1.0
    data += [(3100, alone.tolist())] + [(3101, (alone + 1e-4 * rng.normal(size=24)).tolist()) for _ in range(8)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = permutation_index.nearest(df, least=150, shard_rows=1000, query_rows=20).toPandas()
    ids, all_of = np.array([i for i, _ in data]), np.array([v for _, v in data])
    all_of /= np.linalg.norm(all_of, axis=1, keepdims=True)
    hit = n = 0
    for q in [i for i in ids if i % 50 == 0]:
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and mine.vec_id.is_unique
        if q in same or q == 3050:
            assert mine.vec_id.tolist() == [i for i in same if i != q][:5]
        s = np.round(all_of @ all_of[np.flatnonzero(ids == q)[0]], 12)
        want = dict.fromkeys(ids[i] for i in np.lexsort((ids, -s)) if ids[i] != q)
        hit, n = hit + len(set(list(want)[:5]) & set(mine.vec_id)), n + 5
    assert got[got.query_id == 3100].sort_values("rank").vec_id.iloc[0] == 3101
    assert hit / n >= 0.9


def test_pipeline_stages(spark):
    """Each stage against its operator's own brute-force-tested result, and what the next one gets."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        steps[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns
    before, after = steps["toxicity"]
    y = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    assert sum((i in kept) == (t == 0) for i, t in y.items()) >= 0.93 * len(y)
    before, after = steps["simhash"]
    want = {r["doc_id"] for r in simhash.near_duplicates(before).collect() if r["doc_id"] == r["component_id"]}
    assert {r["doc_id"] for r in after.collect()} == want
    before, after = steps["suffix_array"]
    n = {r["doc_id"]: r["n_bytes"] - r["n_removed"] for r in suffix_array.suffix_dedup(before, corpus_pipeline.REPEAT_BYTES, corpus_pipeline.REPEAT_SEED).collect()}
    assert all(n[r["doc_id"]] - 12 <= len((r["text"] or "").encode()) <= n[r["doc_id"]] for r in after.collect()) and after.count() == len(n)
    before, after = steps["decontamination"]
    leaky = {r["doc_id"] for r in decontaminate.leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - leaky
    before, after = steps["packing"]
    assert rows(after, "doc_id", "piece", "length", "ids_crc32") == rows(packing.pack_documents(before, tokenizer_path()), "doc_id", "piece", "length", "ids_crc32")
    assert after.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_pipeline_on_odd_tables(spark, odd, empty):
    """Nulls, empty and long texts, repeated rows, null ids and clashing columns through all five stages, and an empty table."""
    docs, ids = odd, {r["doc_id"] for r in odd.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        got = {r["doc_id"] for r in docs.collect()}
        assert got and got <= ids
        if name != "packing":
            assert docs.columns == before.columns and docs.schema["text"].dataType == before.schema["text"].dataType
        if name == "simhash":  # repeated rows are one group; the smallest id stays
            assert docs.where("text IS NOT NULL").groupBy("text").count().where("count > 1").count() == 0
        if name == "packing":
            assert before.count() == docs.where("piece = 0").count()  # a document left without text still has its end id
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, empty, SF)
        assert after.count() == 0 and (name == "packing" or after.columns == empty.columns)


def test_passages_of_over_fifty_words_go(spark):
    """Passages of 51 to 70 words in two documents each, none of 400 bytes; documents without one stay as they are."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [p for p in (text(rng.randrange(51, 71)) for _ in range(40)) if len(p) < 400]
    pairs = [(2 * i + j, f"{text(80)} {p} {text(90)}") for i, p in enumerate(shared) for j in (0, 1)]
    clean = [(1000 + i, text(200)) for i in range(30)]
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, make(spark, pairs + clean), SF).collect()}
    assert len(shared) > 20 and not any(p in after[d] for d, _ in pairs for p in [shared[d // 2]])
    assert all(after[d] == t for d, t in clean)
