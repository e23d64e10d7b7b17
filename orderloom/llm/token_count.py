"""Token counts of texts under a unigram model, with scores shared along a trie of pre-tokens.

The pieces are those of a public vocabulary; none is added or dropped. Their probabilities are fitted to the documents by expectation
maximisation over all their different pre-tokens: forward and backward scores once per shared prefix, and expected uses of each
piece, added up over the tasks in every round. A text's segmentation is the one of highest probability (ties: fewer tokens). A character that no piece covers
counts as its UTF-8 bytes, one token each, each scored below every piece.

Pre-tokens are the stretches between white space, with the mark that the vocabulary puts for a word start. The
distinct ones of a batch are sorted and taken level by level of their trie, in arrays: the best score up to a
prefix is computed once for all words that share it, and each terminal keeps its count. Words over ``LONG`` characters are walked one by one. Counts of words already seen by a task are
kept in a bounded table. Documents are counted where they are read; different pre-tokens with their counts are shuffled once.

Defined results: null, empty and white-space texts have 0 pre-tokens and 0 tokens; equal rows are counted each; a null doc_id is
passed on; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.encoding import text_groups
from orderloom.llm.piece_lattice import Lattice, PieceTrie
from orderloom.llm.workspace import Workspace

WORD_START = "▁"
COUNTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])


#: Rounds of the fit, and what every piece counts beside its uses.
ROUNDS, PRIOR = 5, 0.1
#: Different pre-tokens that a task holds while it counts.
HELD = 500_000
#: Characters from which on a word is walked by itself, and characters whose lattice is held at once.
LONG, LATTICE_CHARS = 256, 500_000


def load_pieces(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece model, without its control, unknown and byte entries, with a first guess at their scores: Zipf's
    law over the vocabulary's own order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {piece: -math.log(rank + 1) for rank, piece in enumerate(normal, 1)}


def _hash(word: str) -> int:
    """Of 64 bits, as a signed long."""
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


COUNTED = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
USED = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("uses", T.DoubleType())])


def _counted(stream):
    """Pre-tokens of a task's texts and their counts; a word comes again whenever the table of ``HELD`` words is full."""
    seen: Counter = Counter()

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=COUNTED.names)
    for rows in stream:
        texts = rows.column(0).to_pylist()
        for start, stop in text_groups(texts):
            seen.update(chain.from_iterable(map(str.split, filter(None, texts[start:stop]))))
            if len(seen) > HELD:
                yield batch()
                seen.clear()
    yield batch()


def pretoken_counts(docs: DataFrame) -> DataFrame:
    """word, n: every different pre-token of all documents."""
    return docs.select("text").mapInArrow(_counted, COUNTED).groupBy("word").agg(F.sum("n").alias("n"))


def sampled_pretokens(docs: DataFrame, size: int = 20_000) -> dict[str, int]:
    """Counts over all documents of the ``size`` pre-tokens of smallest hash, for a look at a corpus. The fit takes all."""
    hashed = pretoken_counts(docs).mapInArrow(_hashed, "word string, n long, hash long")
    return {r["word"]: r["n"] for r in hashed.orderBy("hash", "word").limit(size).collect()}


def _hashed(stream):
    for rows in stream:
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(map(_hash, rows.column(0).to_pylist()), pa.int64())], names=["word", "n", "hash"])


def _log_sum(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


#: Below this the probability of a word is summed by logarithms.
LEAST = 1e-250


def _uses_by_logs(steps: list[list[tuple]], n: int, uses: dict[str, float]) -> float:
    """Adds the uses of a word, however improbable, and returns its log-probability."""
    size = len(steps) - 1
    forward, backward = [0.0], [-math.inf] * size + [0.0]
    for here in steps[1:]:
        value = -math.inf
        for start, score, _, _ in here:
            value = _log_sum(value, forward[start] + score)
        forward.append(value)
    for end in range(size, 0, -1):
        for start, score, _, piece in steps[end]:
            through = score + backward[end]
            backward[start] = _log_sum(backward[start], through)
            if piece is not None:
                uses[piece] += n * math.exp(forward[start] + through - forward[size])
    return forward[size]


def _lattices(words: Iterable[str], trie: PieceTrie):
    """Sorted words of at most ``LONG`` characters, in runs, and the lattice of each run."""
    run, size = [], 0
    for word in words:
        if size + len(word) > LATTICE_CHARS:
            yield run, Lattice(run, trie)
            run, size = [], 0
        run.append(word)
        size += len(word)
    if run:
        yield run, Lattice(run, trie)


def expected_uses(words: dict[str, int], pieces: dict[str, float], fallback: float, tails: set[str] | None = None,
                  trie: PieceTrie | None = None) -> tuple[dict[str, float], float]:
    """Of each piece over all segmentations of all words, by their probability, and the words' log-likelihood.

    Scores are computed once for each node of the words' trie; long and improbable words are walked. ``tails``: ``piece_tails(pieces)``, and
    ``trie``: that of the pieces in their order, if known.
    """
    trie = PieceTrie(pieces) if trie is None else trie
    chances = np.exp(np.fromiter(pieces.values(), float, len(pieces)))
    uses, total = np.zeros(len(pieces)), 0.0
    walked = {w: n for w, n in words.items() if len(w) > LONG or not w}
    for run, lattice in _lattices(sorted(w for w in words if 0 < len(w) <= LONG), trie):
        forward = lattice.forward(chances, fallback)
        whole, n = forward[lattice.ends], np.fromiter(map(words.__getitem__, run), float, len(run))
        likely = whole >= LEAST
        walked.update((run[i], words[run[i]]) for i in np.flatnonzero(~likely))
        total += float(n[likely] @ np.log(whole[likely]))
        weights = np.divide(n, whole, out=np.zeros(len(run)), where=likely)
        uses += lattice.uses(forward, weights, chances, fallback)
    out = dict(zip(pieces, uses.tolist()))
    if walked:
        more, rest = _walked_uses(walked, pieces, fallback, tails)
        total += rest
        for piece, u in more.items():
            out[piece] += u
    return out, total


def _walked_uses(words: dict[str, int], pieces: dict[str, float], fallback: float, tails: set[str] | None = None) -> tuple[dict[str, float], float]:
    """``expected_uses``, word by word: forward scores are computed once for each node of the words' trie."""
    tails = piece_tails(pieces) if tails is None else tails
    odds = {p: (s, math.exp(s), p) for p, s in pieces.items()}
    uses: dict[str, float] = dict.fromkeys(pieces, 0.0)
    total, at = 0.0, ""
    forward, steps = [1.0], [[]]  # per prefix: its probability, and the pieces that end there (start, log-probability, probability, piece)
    for word in sorted(words):
        same = 0
        for a, b in zip(at, word):
            if a != b:
                break
            same += 1
        del forward[same + 1:], steps[same + 1:]
        for end in range(same + 1, len(word) + 1):
            score = fallback * len(word[end - 1].encode("utf-8", "surrogatepass"))
            chance = math.exp(score)
            here, value = [(end - 1, score, chance, None)], forward[end - 1] * chance
            for start in range(end - 1, -1, -1):
                piece = word[start:end]
                known = odds.get(piece)
                if known is not None:
                    here.append((start, *known))
                    value += forward[start] * known[1]
                elif piece not in tails:
                    break
            steps.append(here)
            forward.append(value)
        at, n, size = word, words[word], len(word)
        if forward[size] < LEAST:
            total += n * _uses_by_logs(steps, n, uses)
            continue
        total += n * math.log(forward[size])
        backward = [0.0] * size + [n / forward[size]]
        for end in range(size, 0, -1):
            after = backward[end]
            if after:
                for start, _, chance, piece in steps[end]:
                    through = chance * after
                    backward[start] += through
                    if piece is not None:
                        uses[piece] += forward[start] * through
    return uses, total


def piece_tails(pieces: dict[str, float]) -> set[str]:
    """Every ending of a piece, to stop looking when no piece goes on (pieces are read backwards)."""
    return {p[i:] for p in pieces for i in range(len(p))}


def below_all(pieces: dict[str, float]) -> float:
    """The score of a byte that no piece covers."""
    return min(pieces.values(), default=0.0) - 10.0


def fitted(words: dict[str, int], pieces: dict[str, float], rounds: int = ROUNDS, prior: float = PRIOR) -> dict[str, float]:
    """Log-probabilities of the pieces after ``rounds`` of expectation maximisation; without words the first guess stays."""
    marked = {WORD_START + w: n for w, n in words.items()}
    trie = PieceTrie(pieces)
    for _ in range(rounds if marked else 0):
        pieces = _maximised(expected_uses(marked, pieces, below_all(pieces), trie=trie)[0], prior)
    return pieces


def _maximised(uses: dict[str, float], prior: float) -> dict[str, float]:
    whole = math.log(sum(uses.values()) + prior * len(uses))
    return {p: math.log(u + prior) - whole for p, u in uses.items()}


def fitted_to(words: DataFrame, pieces: dict[str, float], rounds: int = ROUNDS, prior: float = PRIOR) -> dict[str, float]:
    """``fitted`` over a table of all words (word, n): each task adds up the uses of its words, and what comes back has a row for each piece."""
    names = list(pieces)
    spark = words.sparkSession
    trie = spark.sparkContext.broadcast(PieceTrie(names))  # like the probabilities, of the vocabulary's size
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(pieces)  # one number for each piece of the vocabulary

        def used(stream):
            known = shared.value
            fallback = below_all(known)
            sums = np.zeros(len(known))
            for rows in stream:
                counts = {WORD_START + w: n for w, n in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())}
                uses = expected_uses(counts, known, fallback, trie=trie.value)[0]
                sums += np.fromiter(uses.values(), float, len(known))
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some], pa.float64())], names=USED.names)

        uses = dict.fromkeys(names, 0.0)
        uses.update((names[r["piece"]], r["uses"]) for r in words.mapInArrow(used, USED).groupBy("piece").agg(F.sum("uses").alias("uses")).collect())
        shared.unpersist()
        if not any(uses.values()):
            break
        pieces = _maximised(uses, prior)
    trie.unpersist()
    return pieces


class TrieCounter:
    def __init__(self, pieces: dict[str, float], table_size: int = 500_000):
        self.pieces = pieces
        self.trie, self.scores = PieceTrie(pieces), np.fromiter(pieces.values(), float, len(pieces))
        self.longest = max(map(len, pieces), default=1)
        self.fallback = below_all(pieces)
        self.table: dict[str, int] = {}
        self.table_size = table_size
        self.tails = piece_tails(pieces)

    def count_new(self, words: Iterable[str]) -> dict[str, int]:
        """Token counts of distinct words: one step for each node of their trie."""
        words = sorted(words)
        out = self._walked(w for w in words if len(w) > LONG or not w)
        for run, lattice in _lattices((w for w in words if 0 < len(w) <= LONG), self.trie):
            out.update(zip(run, lattice.fewest(self.scores, self.fallback).tolist()))
        return out

    def _walked(self, words: Iterable[str]) -> dict[str, int]:
        """The counts of sorted words, one node after the other."""
        pieces, tails, longest = self.pieces, self.tails, self.longest
        scores, counts = [0.0], [0]  # best of each prefix of the word at hand, root first
        at, out = "", {}
        for word in words:
            same = 0
            for a, b in zip(at, word):
                if a != b:
                    break
                same += 1
            del scores[same + 1:], counts[same + 1:]
            for end in range(same + 1, len(word) + 1):
                size = len(word[end - 1].encode("utf-8", "surrogatepass"))
                best, fewest = scores[end - 1] + self.fallback * size, counts[end - 1] + size
                for start in range(end - 1, max(-1, end - 1 - longest), -1):
                    piece = word[start:end]
                    score = pieces.get(piece)
                    if score is not None:
                        score += scores[start]
                        if score > best or (score == best and counts[start] + 1 < fewest):
                            best, fewest = score, counts[start] + 1
                    elif piece not in tails:
                        break
                scores.append(best)
                counts.append(fewest)
            at = word
            out[word] = counts[len(word)]
        return out

    def counts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        out, table = [], self.table
        for start, stop in text_groups(texts):
            cut = [(t or "").split() for t in texts[start:stop]]
            fresh = {w for words in cut for w in words if w not in table}
            new = self.count_new(WORD_START + w for w in fresh)
            listed = [w[1:] for w in new]
            table.update(zip(listed, new.values()))
            out += [(len(words), sum(map(table.__getitem__, words))) for words in cut]
            for w in listed[max(0, len(listed) - max(0, len(table) - self.table_size)):]:
                del table[w]
        return out


_COUNTERS: dict[str, TrieCounter] = {}


def _counter(digest: str, pieces: dict[str, float]) -> TrieCounter:
    """The worker's own counter for the model at hand, which keeps its table from task to task."""
    if digest not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[digest] = TrieCounter(pieces)
    return _COUNTERS[digest]


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens for every row; ``model`` is a sentencepiece model file, read where this is called."""
    ws = Workspace(docs.sparkSession, "pretokens")
    words = ws.store(pretoken_counts(docs).sortWithinPartitions("word"), "counted")  # neighbours share their prefixes
    pieces = fitted_to(words, load_pieces(model))
    ws.drop(words)
    digest = hashlib.sha256(repr(sorted(pieces.items())).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # one number for each piece of the vocabulary

    def counted(stream):
        counts_of = _counter(digest, shared.value)
        for batch in stream:
            pairs = counts_of.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1))],
                                             names=COUNTS.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(counted, COUNTS)
