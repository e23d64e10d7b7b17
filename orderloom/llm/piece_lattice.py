"""All ways to cut many words into pieces at once, in arrays.

Sorted words are taken character by character: each step makes the next level of the words' trie, and every place where a piece may have
begun moves on by one character through the trie of the pieces. What is found is the same for all words that share a prefix: an edge
for each piece that ends at a node, from the node where it begins, and one edge for a character that counts as its bytes. Forward sums,
best scores and backward sums then take one pass over the levels.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_CODE_BITS = 21


class PieceTrie:
    """The trie of the pieces: a hash table from (node, character) to node, and the piece (by its place in the list) that ends at a node."""

    def __init__(self, pieces: Iterable[str]):
        children: dict[int, int] = {}
        ending = [-1]
        for i, piece in enumerate(pieces):
            node = 0
            for char in piece:
                key = node << _CODE_BITS | ord(char)
                node = children.setdefault(key, len(ending))
                if node == len(ending):
                    ending.append(-1)
            if node:
                ending[node] = i
        bits = max(4, (8 * len(children)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        keys, nodes = [-1] * (1 << bits), [-1] * (1 << bits)
        for key, node in children.items():
            slot = (key * int(_ODD) & (1 << 64) - 1) >> 64 - bits
            while keys[slot] >= 0:
                slot = slot + 1 & self._mask
            keys[slot], nodes[slot] = key, node
        self._keys, self._nodes = np.array(keys, np.int64), np.array(nodes, np.int32)
        self.ending = np.array(ending, np.int32)
        self.goes_on = np.zeros(len(ending), bool)
        self.goes_on[[key >> _CODE_BITS for key in children]] = True

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node that each node's character leads to, or -1."""
        keys = nodes.astype(np.int64) << _CODE_BITS | codes
        slots = (keys.view(np.uint64) * _ODD >> self._shift).view(np.int64)
        found = self._keys[slots]
        out = np.where(found == keys, self._nodes[slots], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while open_.size:
            slots[open_] = slots[open_] + 1 & self._mask
            at = slots[open_]
            found = self._keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self._nodes[at[hit]]
            open_ = open_[~hit & (found >= 0)]
        return out


class Level(NamedTuple):
    """The prefixes of one length: nodes from ``first`` on, each with its parent and the bytes of its last character, and the pieces that
    end at them, as edges in the order of their end (``at``: the end, counted from ``first``)."""
    first: int
    parent: np.ndarray
    size: np.ndarray
    start: np.ndarray
    at: np.ndarray
    piece: np.ndarray


class Lattice:
    """``words`` are sorted, different and not empty. ``ends`` has the node of each word; node 0 is the empty prefix."""

    def __init__(self, words: list[str], trie: PieceTrie):
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        offsets = np.cumsum(lengths) - lengths
        self.ends, self.levels = np.zeros(len(words), np.int64), []
        rows, depth, first, nodes = np.arange(len(words)), 0, 0, 1
        # at the nodes of the level above: how many pieces are under way, where these began, and how far they are
        count, begun, state = np.ones(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int32)
        while rows.size:
            above, code = self.ends[rows], codes[offsets[rows] + depth]
            new = np.ones(rows.size, bool)
            new[1:] = (above[1:] != above[:-1]) | (code[1:] != code[:-1])
            self.ends[rows] = nodes - 1 + np.cumsum(new)
            parent, code = above[new], code[new]
            taken = count[parent - first]
            stop = np.cumsum(taken)
            at = np.repeat(np.arange(parent.size), taken)
            from_ = np.repeat((np.cumsum(count) - count)[parent - first] - stop + taken, taken) + np.arange(at.size)
            state = trie.step(state[from_], code[at])
            alive = np.flatnonzero(state >= 0)
            begun, at, state = begun[from_[alive]], at[alive], state[alive]
            piece = trie.ending[state]
            whole = np.flatnonzero(piece >= 0)
            size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
            self.levels.append(Level(nodes, parent, size, begun[whole], at[whole], piece[whole]))
            on = np.flatnonzero(trie.goes_on[state])
            count = np.bincount(at[on], minlength=parent.size) + 1
            fresh = np.cumsum(count) - 1  # a piece may begin at every node, too
            old = np.ones(on.size + parent.size, bool)
            old[fresh] = False
            begun, state = _merged(old, begun[on], fresh, np.arange(nodes, nodes + parent.size)), _merged(old, state[on], fresh, 0)
            first, nodes, depth = nodes, nodes + parent.size, depth + 1
            rows = rows[lengths[rows] > depth]
        self.nodes = nodes

    def forward(self, chances: np.ndarray, byte_score: float) -> np.ndarray:
        """The probability of every prefix, over all its cuts."""
        out = np.zeros(self.nodes)
        out[0] = 1.0
        for first, parent, size, start, at, piece in self.levels:
            out[first:first + parent.size] = (out[parent] * np.exp(byte_score * size)
                                              + np.bincount(at, out[start] * chances[piece], parent.size))
        return out

    def uses(self, forward: np.ndarray, weights: np.ndarray, chances: np.ndarray, byte_score: float) -> np.ndarray:
        """How often each piece is expected in all words; ``weights``: each word's count by its probability."""
        backward = np.zeros(self.nodes)
        backward[self.ends] = weights
        pieces, shares = [], []
        for first, parent, size, start, at, piece in reversed(self.levels):
            after = backward[first:first + parent.size]
            through = chances[piece] * after[at]
            pieces.append(piece)
            shares.append(forward[start] * through)
            np.add.at(backward, start, through)
            np.add.at(backward, parent, np.exp(byte_score * size) * after)
        if not pieces:
            return np.zeros(chances.size)
        return np.bincount(np.concatenate(pieces), np.concatenate(shares), chances.size)

    def fewest(self, scores: np.ndarray, byte_score: float) -> np.ndarray:
        """The number of tokens in each word's cut of best score, the fewest if several have it."""
        best, counts = np.zeros(self.nodes), np.zeros(self.nodes, np.int64)
        for first, parent, size, start, at, piece in self.levels:
            here = best[parent] + byte_score * size
            tokens = counts[parent] + size
            score = scores[piece] + best[start]
            top = here.copy()
            np.maximum.at(top, at, score)
            tokens[here < top] = np.iinfo(np.int64).max
            equal = np.flatnonzero(score == top[at])
            np.minimum.at(tokens, at[equal], counts[start[equal]] + 1)
            best[first:first + parent.size], counts[first:first + parent.size] = top, tokens
        return counts[self.ends]


def _merged(old: np.ndarray, values: np.ndarray, fresh: np.ndarray, more) -> np.ndarray:
    out = np.empty(old.size, values.dtype)
    out[old], out[fresh] = values, more
    return out
