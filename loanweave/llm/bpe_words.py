"""Ids of whole texts under a word-splitting byte-pair vocabulary, word by word.

Most words of a text occur often, so ids are kept per white-space-separated word. Plain Latin words
that are new in a batch are merged together: all words of about one length form a matrix, and every
step merges each row's pair of lowest rank. Everything else goes through the ``tokenizers`` library.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NONE = np.int32(2**31 - 1)
LONGEST = 48
ROWS_AT_ONCE = 1 << 15
KEPT_WORDS = 800_000
# Letters up to U+00FF and ASCII marks without the apostrophe: no contraction, no composition, plain lower-casing.
# Beyond ASCII these are the letters whose first byte is 0xC3, but for two signs.
OTHER = np.array([not 33 <= b < 127 or b == 39 for b in range(128)] + [b >= 0xC0 and b != 0xC3 for b in range(128, 256)])
SIGNS = (0x97, 0xB7)
# Pieces of lower-cased words: letters, one digit, or marks.
LETTER, DIGIT, MARK = range(3)
KINDS = np.array([LETTER if b >= 128 or 97 <= b < 123 else DIGIT if 48 <= b < 58 else MARK for b in range(256)], np.int8)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + k) for k, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


def _listed(values: pa.Array) -> list[bytes]:
    return values.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _joined(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """All values one after another, and where each begins, then the end."""
    _, begins, flat = values.buffers()
    return b"" if flat is None else flat.to_pybytes(), np.frombuffer(begins, np.int32, len(values) + 1, 4 * values.offset)


class WordIds:
    """``ids(texts)``: the ids of each text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.final = np.array([vocab[x + "</w>"] for x in letters], np.int64)
        self.size = len(vocab)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        # Ranks of two bytes, the second one inside (first half) or at the end of a piece.
        self.byte_ranks = self.ranks(self.inner[:, None], np.concatenate([self.inner, self.final])[None, :])
        self.words: dict[bytes, bytes] = {b"": b""}
        self.pieces: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if len(self.words) > KEPT_WORDS:
            self.words, self.pieces = {b"": b""}, {}
        # Only the library knows special tokens, and it finds them before lower-casing.
        special = [b"<|" in t for t in texts]
        lower = pa.array([b"" if own else t.lower() for t, own in zip(texts, special, strict=True)], pa.binary())
        split = pc.ascii_split_whitespace(lower.cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        words = _listed(coded.dictionary)
        own = list(map(self.words.get, words))
        new = [k for k, ids in enumerate(own) if ids is None]
        for k, ids in zip(new, self._learned([words[k] for k in new]), strict=True):
            own[k] = ids
        found = pa.array(own, pa.binary()).take(coded.indices)
        flat, begins = _joined(found)
        begins = begins[split.offsets.to_numpy()].tolist()
        return [
            self._by_library(text.decode()) if own else flat[a:b]
            for text, own, a, b in zip(texts, special, begins, begins[1:], strict=False)
        ]

    def _by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learned(self, words: list[bytes]) -> list[bytes]:
        """The ids of new words, which are kept."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        other = OTHER[raw]
        other[1:] |= np.isin(raw[1:], SIGNS) & (raw[:-1] == 0xC3)
        plain = (np.add.reduceat(other, np.cumsum(lengths) - lengths, dtype=np.int64) == 0) & (lengths <= LONGEST)
        ids = [b""] * len(words)
        for k in np.flatnonzero(~plain).tolist():
            ids[k] = self._by_library(words[k].decode())
        rows = np.flatnonzero(plain)
        if len(rows):
            for k, own in zip(rows.tolist(), self._cut([words[k] for k in rows.tolist()], lengths[rows]), strict=True):
                ids[k] = own
        self.words.update(zip(words, ids, strict=True))
        return ids

    def _cut(self, words: list[bytes], lengths: np.ndarray) -> list[bytes]:
        """The ids of plain words by those of their pieces."""
        lower = b"".join(words).decode().lower().encode()
        kinds = KINDS[np.frombuffer(lower, np.uint8)]
        begins = np.cumsum(lengths) - lengths
        new = (kinds == DIGIT) | (np.diff(kinds, prepend=-1) != 0)
        new[begins] = True
        edges = np.append(np.flatnonzero(new), len(lower)).astype(np.int32)
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(lower)]).dictionary_encode()
        pieces = _listed(coded.dictionary)
        unseen = [p for p in pieces if p not in self.pieces]
        self.pieces.update(zip(unseen, self.merge_all(unseen), strict=True))
        found = pa.array(list(map(self.pieces.__getitem__, pieces)), pa.binary()).take(coded.indices)
        flat, places = _joined(found)
        places = places[np.searchsorted(edges, np.append(begins, len(lower)))].tolist()
        return [flat[a:b] for a, b in zip(places, places[1:], strict=False)]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[place] == key) & (left >= 0) & (right >= 0), self.pair_ranks[place], NONE)

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(lengths, kind="stable")
        for at in range(0, len(order), ROWS_AT_ONCE):
            rows = order[at : at + ROWS_AT_ONCE]
            for row, ids in zip(rows.tolist(), self._merged([pieces[r] for r in rows], lengths[rows]), strict=True):
                out[row] = ids
        return out

    def _merged(self, pieces: list[bytes], lengths: np.ndarray) -> list[bytes]:
        width = int(lengths.max())
        steps = np.arange(width)
        # One column more, always empty, so that moving left brings an empty place in.
        ids = np.full((len(pieces), width + 1), -1, np.int64)
        inside = steps < lengths[:, None]
        raw = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths) - 1
        own = self.inner[raw]
        own[ends] = self.final[raw[ends]]
        ids[:, :-1][inside] = own
        behind = np.append(raw[1:], 0)
        behind[ends - 1] += 256
        pair = self.byte_ranks[raw, behind]
        pair[ends] = NONE
        rank = np.full((len(pieces), width), NONE)
        rank[inside] = pair
        live = np.arange(len(pieces))
        done = np.full((len(pieces), width), -1, np.int64)
        while len(live):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), at]
            ended = best == NONE
            if ended.any():
                done[live[ended]] = ids[ended, :-1]
                go = ~ended
                live, ids, rank, at, best = live[go], ids[go], rank[go], at[go], best[go]
                if not len(live):
                    break
            row = np.arange(len(live))
            ids[row, at] = self.merged[best]
            behind = steps > at[:, None]
            ids[:, :-1] = np.where(behind, ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NONE
            rank[row, at] = self.ranks(ids[row, at], ids[row, at + 1])
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self.ranks(ids[before, at[before] - 1], ids[before, at[before]])
        sizes = (done >= 0).sum(axis=1)
        flat = done[done >= 0].astype("<u4").tobytes()
        ends = np.cumsum(sizes) * 4
        return [flat[e - 4 * s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
