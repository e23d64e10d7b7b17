"""Toxic spans and document scores by a linear-chain conditional random field.

Training, on the driver, from a bounded sample of labelled documents (``sample_toxic`` + ``sample_clean``):

1. Features of a token (a run of letters, lower case): the word and its first three and four letters. Their document counts per label
   come from one Spark pass over the sampled texts.
2. A small set of features that explains the toxic documents is picked greedily: each covers the most toxic documents that
   none before it covers, among features that are rare in clean ones. So a feature that many copies of one document share
   adds nothing where a general one explains them already.
3. Token labels: 1 for tokens of toxic documents with a picked feature, 0 for all others. The field has tags 0 and 1, a weight for each
   feature, and weights for entering, staying in and leaving tag 1. Its conditional likelihood is maximised by gradient steps.

Scoring, on the executors: forward-backward over the whole text. Tokens without a picked feature have all the same emission,
so the step over a stretch of them is a power of one 2x2 matrix; the marginals are exact and only tokens with a
feature cost time. Score of a document: 1 - prod(1 - p) over the marginals p of tag 1 at these tokens and that of a neutral text.
Offending spans are the stretches of tokens whose marginal is 0.5 or more, as character offsets.

Defined results: null and empty texts, and texts without letters, get the neutral score (under 0.5, no spans). Equal rows get equal
scores. A doc_id with several labels counts as toxic if one says so; null labels and labels of a null doc_id
are ignored. Without labelled documents of both kinds nothing can be learnt: every score is 0. Other columns are passed over.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.workspace import Workspace

SAMPLE_TOXIC = 4096
SAMPLE_CLEAN = 8192
#: Features: log odds of a toxic against a clean document, at least; uncovered toxic documents a pick adds, at least this share.
LEAST_ODDS = 3.0
LEAST_SHARE = 0.002
LEAST_COUNT = 3
COMMON_SHARE = 0.02
#: Toxic documents that a feature must add for each clean one that it is in.
CLEAN_COST = 10
MOST_FEATURES = 512
#: Stretches with features that the weights are fitted to.
FIT_STRETCHES = 4096
_TOKEN = re.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[str, ...]:
    """Names of a token's features: the word, and prefixes shorter than it."""
    return ("=" + word, *(f"^{word[:n]}" for n in (3, 4) if len(word) > n))


@dataclass
class Model:
    """Weights of the field. ``enter``, ``stay`` and ``leave`` are scores of 0->1, 1->1 and 1->0; 0->0 has score 0."""

    weights: dict[str, float] = field(default_factory=dict)
    enter: float = 0.0
    stay: float = 0.0
    leave: float = 0.0
    trained: bool = False

    def emission(self, word: str) -> float | None:
        found = [self.weights[f] for f in features(word) if f in self.weights]
        return sum(found) if found else None

    def step(self) -> np.ndarray:
        return np.exp(np.array([[0.0, self.enter], [self.leave, self.stay]]))


class Powers:
    """Powers of the neutral step, scaled to a largest eigenvalue of 1, from its eigenvectors."""

    def __init__(self, step: np.ndarray):
        values, vectors = np.linalg.eig(step)
        by = np.argsort(-values.real)
        self.large = float(values.real[by[0]])
        self.ratio = float(values.real[by[1]]) / self.large
        right = vectors.real[:, by]
        left = np.linalg.inv(right)
        self.first = np.outer(right[:, 0], left[0])
        self.second = np.outer(right[:, 1], left[1])

    def __call__(self, n):
        """n: a number or an array; the result has two more axes."""
        r = np.power(self.ratio, np.asarray(n, float))
        return self.first + np.multiply.outer(r, self.second)


def marginals(model: Model, powers: Powers, n: int, places: list[int], emissions: list[float]) -> np.ndarray:
    """P(tag 1) at ``places`` of a text of ``n`` tokens; all other tokens are neutral. Before the text stands tag 0."""
    gaps = np.diff(np.concatenate(([-1], places, [n - 1])))
    steps = powers(gaps)
    lift = np.exp(np.minimum(emissions, 500.0))
    forward = np.zeros((len(places), 2))
    now = np.array([1.0, 0.0])
    for i in range(len(places)):
        now = now @ steps[i]
        now = np.array([now[0], now[1] * lift[i]])
        now /= now.sum()
        forward[i] = now
    out = np.zeros(len(places))
    after = steps[-1] @ np.ones(2)
    for i in range(len(places) - 1, -1, -1):
        both = forward[i] * after
        out[i] = both[1] / both.sum()
        after = steps[i] @ (after * np.array([1.0, lift[i]]))
        after /= after.sum()
    return out


def neutral_marginal(model: Model) -> float:
    """P(tag 1) inside a long text without any feature."""
    values, right = np.linalg.eig(model.step())
    values_l, left = np.linalg.eig(model.step().T)
    both = right[:, np.argmax(values.real)].real * left[:, np.argmax(values_l.real)].real
    return float(both[1] / both.sum())


def _likelihood(theta: np.ndarray, data, l2: float) -> tuple[float, np.ndarray]:
    """Log-likelihood per document and its gradient. data: padded arrays of the sampled documents (see ``fit``)."""
    gaps, tail, hits, live, gold, transitions, plain, n_all = data
    n_docs = len(gaps)
    w, e = theta[:-3], theta[-3:]

    def log_z(enter, stay, leave):
        powers = Powers(np.exp(np.array([[0.0, enter], [leave, stay]])))
        now = np.zeros((n_docs, 2))
        now[:, 0] = 1.0
        total = np.zeros(n_docs)
        forward, steps = [], powers(gaps)
        for i in range(gaps.shape[1]):
            nxt = np.einsum("dj,djk->dk", now, steps[:, i])
            nxt[:, 1] *= lift[:, i]
            size = nxt.sum(axis=1)
            now = np.where(live[:, i, None], nxt / size[:, None], now)
            total += np.where(live[:, i], np.log(size), 0.0)
            forward.append(now)
        last = powers(tail) @ np.ones(2)
        total += np.log((now * last).sum(axis=1))
        total += ((gaps * live).sum(axis=1) + tail) * math.log(powers.large)
        without = np.log(powers(plain)[:, 0].sum(axis=1)).sum() + plain.sum() * math.log(powers.large)
        return total.sum() + without, forward, steps, last

    lift = np.exp(np.minimum((w[hits] * (hits >= 0)).sum(axis=2), 200.0))
    total, forward, steps, after = log_z(*e)
    score = float((gold * (w[hits] * (hits >= 0)).sum(axis=2)).sum() + (transitions @ e).sum())
    gradient = np.zeros_like(theta)
    expected = np.zeros(gaps.shape)
    for i in range(gaps.shape[1] - 1, -1, -1):
        both = forward[i] * after
        expected[:, i] = np.where(live[:, i], both[:, 1] / both.sum(axis=1), 0.0)
        lifted = after.copy()
        lifted[:, 1] *= lift[:, i]
        back = np.einsum("djk,dk->dj", steps[:, i], lifted)
        after = np.where(live[:, i, None], back / back.sum(axis=1, keepdims=True), after)
    use = hits >= 0
    np.add.at(gradient, hits[use], np.broadcast_to((gold - expected)[:, :, None], hits.shape)[use])
    for i in range(3):
        shift = np.zeros(3)
        shift[i] = 1e-4
        gradient[len(w) + i] = transitions[:, i].sum() - (log_z(*(e + shift))[0] - total) / 1e-4
    value = (score - total) / n_all - l2 * float(theta @ theta)
    return value, gradient / n_all - 2 * l2 * theta


def fit(documents: list[tuple[int, list[tuple[int, tuple[int, ...]]], bool]], n_features: int, rounds: int = 100, l2: float = 1e-5,
        most_hits: int = 16, most_stretches: int = FIT_STRETCHES) -> np.ndarray:
    """Weights from documents (tokens, [(place, features)], toxic).

    Longer hit lists are cut into stretches of ``most_hits``; at most ``most_stretches`` of the documents with hits are used, and all without.
    """
    cut = []
    plain = np.array([n for n, hits, _ in documents if not hits], float)
    for n, hits, toxic in documents:
        if len(cut) >= most_stretches:
            break
        for a in range(0, len(hits), most_hits):
            part = hits[a:a + most_hits]
            first = part[0][0] if a else 0
            end = hits[a + most_hits][0] if a + most_hits < len(hits) else n
            cut.append((end - first, [(p - first, f) for p, f in part], toxic))
    n_docs, most = len(cut), max([1, *(len(h) for _, h, _ in cut)])
    wide = max([1, *(len(f) for _, h, _ in cut for _, f in h)])
    gaps, live = np.zeros((n_docs, most)), np.zeros((n_docs, most), bool)
    hits, gold = np.full((n_docs, most, wide), -1), np.zeros((n_docs, most))
    tail, transitions = np.zeros(n_docs), np.zeros((n_docs, 3))
    for d, (n, found, toxic) in enumerate(cut):
        before = -1
        for i, (place, fs) in enumerate(found):
            gaps[d, i], live[d, i], gold[d, i] = place - before, True, toxic
            hits[d, i, :len(fs)] = fs
            if toxic:  # neutral tokens have tag 0
                beside = i > 0 and place - before == 1
                transitions[d, 1 if beside else 0] += 1
                if i > 0 and not beside:
                    transitions[d, 2] += 1
            before = place
        if found and toxic and before < n - 1:
            transitions[d, 2] += 1
        tail[d] = n - 1 - before
    data = (gaps, np.maximum(tail, 0), hits, live, gold, transitions, plain, max(1, n_docs + len(plain)))
    theta = np.concatenate((np.full(n_features, 2.0), [-4.0, -1.0, 0.0]))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        _, g = _likelihood(theta, data, l2)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _sample(docs: DataFrame, labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """doc_id, text, y: one row per picked doc_id, of its rows the one whose text has the smallest hash."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").cast("int").alias("y")).where(~held_out(F.col("doc_id"))))
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic), (0, clean))]
    few = picked[0].unionByName(picked[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id")
    first = F.struct(F.col("text").isNull(), F.xxhash64("text"))
    return rows.groupBy("doc_id").agg(F.min_by("text", first).alias("text"), F.max("y").alias("y"))


def train(docs: DataFrame, labels: DataFrame, sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out: by hash of doc_id, one row for each."""
    def counted(stream):
        for batch in stream:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                seen[min(1, max(0, y))].update({f for w in set(_TOKEN.findall((text or "").lower())) for f in features(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in seen)],
                                             names=["f", "clean", "toxic"])

    ws = Workspace(docs.sparkSession, "toxicity")
    sample = ws.store(_sample(docs, labels, sample_toxic, sample_clean), "sample")
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sum(n for y, n in totals.items() if y > 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()
    counts = sample.mapInArrow(counted, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    # bounded: features of a bounded sample, and of those the ones with most support
    able = counts.where((F.col("toxic") >= LEAST_COUNT) & (odds >= LEAST_ODDS)).orderBy(F.desc("toxic"), "clean", F.desc(F.length("f")), "f").limit(20_000)
    able = able.collect()
    names = {r["f"]: i for i, r in enumerate(able)}

    def incidence(stream):
        for batch in stream:
            rows = []
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = _TOKEN.findall((text or "").lower())
                if y > 0:
                    of = {f for w in set(words) for f in features(w)}
                    rows.append([names[f] for f in of if f in names])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], names=["fs"])

    covered = [set(r["fs"]) for r in sample.mapInArrow(incidence, "fs array<int>").collect()]
    picked = pick(covered, [CLEAN_COST * r["clean"] for r in able], max(LEAST_COUNT, LEAST_SHARE * n_toxic), max(LEAST_COUNT, COMMON_SHARE * n_toxic))
    chosen = {f: picked.index(i) for f, i in names.items() if i in set(picked)}
    if not chosen:
        return Model()

    def sequences(stream):
        for batch in stream:
            rows = []
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = _TOKEN.findall((text or "").lower())
                hits = []
                for i, w in enumerate(words):
                    fs = [chosen[f] for f in features(w) if f in chosen]
                    if fs:
                        hits.append({"place": i, "fs": fs})
                rows.append((len(words), hits, y > 0))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.struct(
                [("place", pa.int64()), ("fs", pa.list_(pa.int32()))]))), pa.array(columns[2], pa.bool_())], names=["n", "hits", "y"])

    found = sample.mapInArrow(sequences, "n long, hits array<struct<place: long, fs: array<int>>>, y boolean").collect()
    # in an order that doesn't depend on partitions
    found = sorted(found, key=lambda r: (r["n"], r["y"], len(r["hits"]), r["hits"][:1]), reverse=False)
    found = [found[i] for i in np.random.default_rng(0).permutation(len(found))]
    documents = [(r["n"], [(h["place"], tuple(h["fs"])) for h in r["hits"]], r["y"]) for r in found if r["n"]]
    if not documents:
        return Model()
    theta = fit(documents, len(chosen))
    return Model({f: float(theta[i]) for f, i in chosen.items()}, float(theta[-3]), float(theta[-2]), float(theta[-1]), True)


def pick(covered: list[set[int]], cost: list[int], least: float, common: float) -> list[int]:
    """Features one by one, each the one with most documents that no feature before it is in, less its ``cost``; ties to the smaller number.

    Then those that at least ``common`` documents have, if these were covered by three different features or more: words that
    stand beside various others, and not the particular words of one much copied document.
    """
    of: list[list[int]] = [[] for _ in cost]
    for d, fs in enumerate(covered):
        for f in fs:
            of[f].append(d)
    left = np.array([len(o) - c for o, c in zip(of, cost)])
    by = np.full(len(covered), -1)
    out: list[int] = []
    while len(left) and len(out) < MOST_FEATURES:
        best = int(np.argmax(left))
        if left[best] < least:
            break
        out.append(best)
        for d in of[best]:
            if by[d] < 0:
                by[d] = best
                left[list(covered[d])] -= 1
    for f in range(len(cost)):
        if len(out) < MOST_FEATURES and f not in out and len(of[f]) - cost[f] >= common and len(set(by[of[f]].tolist()) - {-1}) >= 3:
            out.append(f)
    return out


class Scorer:
    def __init__(self, model: Model, table_size: int = 1_000_000):
        self.model = model
        self.powers = Powers(model.step()) if model.trained else None
        self.neutral = neutral_marginal(model) if model.trained else 0.0
        self.plain: set[str] = set()
        self.table_size = table_size

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Score and offending spans (first character, end, largest marginal)."""
        if not self.model.trained or not text:
            return self.neutral, []
        new = set(_TOKEN.findall(text.lower())) - self.plain
        marked = {w for w in new if self.model.emission(w) is not None}
        if len(self.plain) < self.table_size:
            self.plain |= new - marked
        if not marked:
            return self.neutral, []
        n, places, emissions, offsets = 0, [], [], []
        for m in _TOKEN.finditer(text):
            w = m[0].lower()
            if w in marked:
                places.append(n)
                emissions.append(self.model.emission(w))
                offsets.append(m.span())
            n += 1
        if not places:
            return self.neutral, []
        p = marginals(self.model, self.powers, n, places, emissions)
        score = 1.0 - (1.0 - self.neutral) * float(np.prod(1.0 - np.minimum(p, 1.0)))
        spans: list[tuple[int, int, float]] = []
        before = None
        for place, (start, end), q in zip(places, offsets, p.tolist()):
            if q >= 0.5:
                if spans and before == place - 1:
                    spans[-1] = (spans[-1][0], end, max(spans[-1][2], q))
                else:
                    spans.append((start, end, q))
                before = place
        return score, spans


SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and spans (array of start, end, p) of every row."""
    def tagged(stream):
        scorer = Scorer(model)
        for batch in stream:
            found = [scorer.score(t) for t in batch.column(1).to_pylist()]
            scores = pa.array([s for s, _ in found], pa.float64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), scores, pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                pa.array([[{"start": a, "end": b, "p": p} for a, b, p in spans] for _, spans in found], SPAN)],
                names=["doc_id", "score", "predicted", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        tagged, "doc_id long, score double, predicted int, spans array<struct<start: int, end: int, p: double>>")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and the offending spans."""
    return tag(docs, train(docs, labels)).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted", "spans")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that the model doesn't predict as toxic."""
    at = docs.columns.index("text")

    def clean(stream):
        scorer = Scorer(model)
        for batch in stream:
            keep = [scorer.score(t)[0] < 0.5 for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
