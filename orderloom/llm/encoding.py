"""Token ids of whole texts with the ``tokenizers`` library."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Longest run of texts, in characters, that is encoded in one go.
GROUP_CHARS = 2_000_000


def text_groups(texts: Sequence[str | None], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a batch into index ranges of at most ``limit`` characters, or one text."""
    start = size = 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if i > start and size + length > limit:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids.

    The byte-level pattern always starts a new pre-token at a space that a non-space follows. A text
    is cut there, each distinct piece is encoded once, and the ids are put together again in whole-array steps; a text
    with other spacing goes to the library whole. A new piece of plain characters is cut on into its pre-tokens, so words are
    known with and without punctuation. Special-token strings are ordinary text. The tables
    are bounded; pieces beyond them are encoded again when they come again.
    """

    def __init__(self, path: str, table_size: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        self._table_size = table_size
        self._table: dict[str, int] = {}  # row of a piece after a space
        self._ids, self._ends = np.zeros(0, "<u4"), np.zeros(2, np.int64)  # ids of the rows one after another, where each ends; row 0 is empty
        self._parts: dict[str, bytes] = {}  # ids of pre-tokens that are no pieces of the table

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token: the model takes it as it is, in the byte-level alphabet."""
        row = self._table.get(part[1:]) if part[0] == " " else None
        if row is not None:
            return self._ids[self._ends[row]:self._ends[row + 1]].tobytes()
        printed = "\u0120" + part[1:] if part[0] == " " and part.isascii() else part.translate(_PRINTED)
        ids = array("I", [t.id for t in self._model.tokenize(printed)]).tobytes()
        if len(self._parts) < self._table_size // 4:
            self._parts[part] = ids
        return ids

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces with the space before them, if there is one."""
        known, new = self._parts.get, self._part
        out: list[bytes | None] = []
        for piece in pieces:
            ids = known(piece)
            if ids is None:
                word = piece[1:]
                # Letters up to U+058F are letters in every version of Unicode that the library may know.
                if word.isalpha() and piece[0] == " " and (word.isascii() or max(word) < "\u0590"):
                    ids = new(piece)
                else:
                    parts = _PARTS.findall(piece)
                    if sum(map(len, parts)) == len(piece):
                        ids = b"".join([known(p) or new(p) for p in parts])
            out.append(ids)
        left = [i for i, ids in enumerate(out) if ids is None]
        for a in range(0, len(left), 10_000):
            part = left[a:a + 10_000]
            for i, ids in zip(part, self._encode([pieces[i] for i in part])):
                out[i] = ids
        return out

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text; a null text counts as empty."""
        out: list[bytes] = []
        for start, end in text_groups(texts):
            out += self._encode_group([t or "" for t in texts[start:end]])
        return out

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        table = self._table
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        starts = cut.offsets.to_numpy()
        pieces = cut.values.dictionary_encode()
        place = pieces.indices.to_numpy()
        after_space = np.ones(len(place), bool)
        after_space[starts[:-1]] = False
        used = np.zeros(len(pieces.dictionary), bool)
        used[place[after_space]] = True
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        rows = np.fromiter(map(table.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(used & (rows < 0)).tolist()
        odd = [i for i in missing if not distinct[i] or distinct[i][0].isspace()]
        if odd:
            rows[odd] = 0
            missing = [i for i in missing if rows[i] < 0]
        heads = list(dict.fromkeys(distinct[i] for i in place[starts[:-1]].tolist()))
        made = self._encode_pieces([" " + distinct[i] for i in missing]) + self._encode_pieces(heads)

        base = len(self._ends) - 1
        rows[missing] = np.arange(base, base + len(missing))
        head_rows = dict(zip(heads, range(base + len(missing), base + len(made))))
        row = rows[place]
        row[starts[:-1]] = [head_rows[distinct[i]] for i in place[starts[:-1]].tolist()]
        ids = np.concatenate((self._ids, np.frombuffer(b"".join(made), "<u4")))
        ends = np.concatenate((self._ends, self._ends[-1] + np.cumsum([len(m) // 4 for m in made], dtype=np.int64)))

        length = ends[row + 1] - ends[row]
        stops = np.concatenate(([0], np.cumsum(length)))
        joined = ids[np.arange(stops[-1]) + np.repeat(ends[row] - stops[:-1], length)].tobytes()
        bounds = (stops[starts] * 4).tolist()
        out = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        if odd:
            is_odd = np.zeros(len(distinct), bool)
            is_odd[odd] = True
            whole = np.unique(np.searchsorted(starts, np.flatnonzero(is_odd[place] & after_space), side="right") - 1).tolist()
            for i, whole_ids in zip(whole, self._encode([texts[i] for i in whole])):
                out[i] = whole_ids

        keep = missing[:max(0, self._table_size - len(table))]  # the newest stay out
        if keep:
            table.update(zip((distinct[i] for i in keep), range(base, base + len(keep))))
            self._ends = ends[:base + len(keep) + 1].copy()
            self._ids = ids[:self._ends[-1]].copy()
            for i in keep:
                self._parts.pop(" " + distinct[i], None)
        return out


#: The byte-level pattern for pieces of these characters only: no other one is a letter, digit, mark or space to it in their midst.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u052f"
_PARTS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[!-/:-@\[-`{{-~]+|\n+(?!\S)|\n+")

class _Printed(dict):
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""

    def __missing__(self, code: int) -> str:
        self[code] = "".join(chr(_BYTES.get(b, b)) for b in chr(code).encode())
        return self[code]


_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTES = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_PRINTED = _Printed()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's own encoder, which keeps its table from task to task."""
    return Encoder(path)
