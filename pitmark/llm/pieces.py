"""A fixed piece vocabulary as sorted keys, and piece lattices of equal-length words."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
import sentencepiece

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SCRAMBLE = np.uint64(0xD6E8FEB86659FD93)


def by_length(words: list[str]) -> dict[int, list[int]]:
    """Places of the words of each length."""
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def codes(words: list[str], length: int) -> np.ndarray:
    """(word, place) -> code point, for words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), length)


class PieceTable:
    """Pieces by the hash of their characters: sorted keys, probed by binary search."""

    def __init__(self, name: str):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        n = model.get_piece_size()
        self.model, self.size, self.unknown = model, n, model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.scores = np.array([model.get_score(i) for i in range(n)])
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.longest = max(len(self.pieces[i]) for i in normal)
        self.powers = _BASE ** np.arange(self.longest + 1, dtype=np.uint64)
        keys = np.empty(len(normal), np.uint64)
        for length, at in by_length([self.pieces[i] for i in normal]).items():
            c = codes([self.pieces[normal[k]] for k in at], length)
            keys[at] = self._key(self._prefix(c), 0, length)[:, 0]
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal, np.int32)[order]
        assert (np.diff(self.keys) > 0).all(), "two pieces share a key"
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True

    def _prefix(self, c: np.ndarray) -> np.ndarray:
        out = np.zeros((len(c), c.shape[1] + 1), np.uint64)
        for j in range(c.shape[1]):
            out[:, j + 1] = out[:, j] * _BASE + c[:, j]
        return out

    def _key(self, prefix: np.ndarray, start: int, length: int) -> np.ndarray:
        """Keys of all substrings of a length from ``start`` on."""
        stop = prefix.shape[1] - length
        x = prefix[:, start + length :][:, : stop - start] - prefix[:, start:stop] * self.powers[length]
        x = (x + np.uint64(length)) * _SCRAMBLE
        return (x ^ (x >> np.uint64(32))) * _SCRAMBLE

    def lattice(self, c: np.ndarray) -> list[np.ndarray]:
        """For each piece length from 1 on: (word, start) -> piece id, -1 where the substring is no piece."""
        prefix, out = self._prefix(c), []
        for length in range(1, min(self.longest, c.shape[1]) + 1):
            x = self._key(prefix, 0, length)
            found = np.full(x.shape, -1, np.int32)
            hit = self.maybe[x >> np.uint64(44)]
            y = x[hit]
            at = np.minimum(np.searchsorted(self.keys, y), len(self.keys) - 1)
            found[hit] = np.where(self.keys[at] == y, self.ids[at], -1)
            out.append(found)
        return out


@lru_cache(maxsize=2)
def piece_table(name: str) -> PieceTable:
    return PieceTable(name)
