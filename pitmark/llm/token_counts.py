"""Token counts that follow edits: a segment tree over the pre-tokens of each document."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmark.llm import pretokens
from pitmark.llm.common import texts_of

#: Pre-tokens in a leaf.
LEAF = 16
_EDITS = "array<struct<start:int,end:int,text:string>>"
#: Characters before and after an edit on which no cut within reach depends.
_MARGIN = 4
_UNKNOWN, _BLANK, _LETTER, _DIGIT, _MARK = range(5)
_COUNTS = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_chars_encoded"]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point what the tokenizer's pattern takes it for; unknown where versions of Unicode may not agree."""
    first = {"L": _LETTER, "N": _DIGIT}
    kinds = np.array([_UNKNOWN if (c := unicodedata.category(chr(k))) in ("Cn", "Cs") else first.get(c[0], _MARK) for k in range(0x20000)] + [_UNKNOWN], np.uint8)
    kinds[[*map(ord, pretokens.WHITE)]] = _BLANK
    # separators that not all take for white space, and the ends of the special token
    kinds[[28, 29, 30, 31, *map(ord, "<|>")]] = _UNKNOWN
    return kinds


def safe_cuts(text: str) -> np.ndarray:
    """Places where a pre-token begins whatever stands two characters and more away, in either direction.

    They are: before a space that a non-space follows; before white space after
    anything else; after a single white character that is no space; between
    letters, digits and marks, but not after an apostrophe. Nothing is cut next
    to the characters that begin and end a special token, so none spans a cut.
    """
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(c) < 2:
        return np.zeros(0, np.int64)
    k = _kinds()[np.minimum(c, 0x20000)]
    a, b = k[:-1], k[1:]
    space = c == 32
    known, blank = k != _UNKNOWN, k == _BLANK
    cut = known[:-1] & known[1:] & (a != b) & ~blank[:-1] & (blank[1:] | (c[:-1] != 39))  # a run of its kind ends
    cut[:-1] |= space[1:-1] & known[2:] & ~blank[2:]
    cut[1:] |= blank[1:-1] & ~space[1:-1] & known[2:] & ~blank[2:] & known[:-2] & ~blank[:-2]
    return np.flatnonzero(cut) + 1


class TokenTree:
    """Leaves of neighbouring pre-tokens with their characters and tokens; inner nodes are sums.

    ``sums`` is a heap of (characters, tokens): node k has children 2k and 2k + 1.
    """

    def __init__(self, sums: np.ndarray):
        self.sums, self.width, self.encoded = sums, len(sums) // 2, 0

    @classmethod
    def of(cls, text: str, tokenizer: str) -> TokenTree:
        starts = np.concatenate([[0], safe_cuts(text)[LEAF - 1 :: LEAF]])
        stops = np.append(starts[1:], len(text))
        ids = pretokens.ids(text, tokenizer)
        if len(starts) == 1:
            tokens = np.array([len(ids)])
        else:  # the tokens' bytes say in which leaf they lie
            lengths = pretokens.byte_lengths(tokenizer)[ids]
            raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            place = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[stops]
            tokens = np.diff(np.searchsorted(np.cumsum(lengths), place, side="right"), prepend=0)
        width = 1 << (len(starts) - 1).bit_length()
        sums = np.zeros((2 * width, 2), np.int64)
        sums[width : width + len(starts)] = np.stack([stops - starts, tokens], 1)
        k = width
        while k > 1:
            sums[k // 2 : k] = sums[k : 2 * k : 2] + sums[k + 1 : 2 * k : 2]
            k //= 2
        return cls(sums)

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character and where it starts; the last filled leaf for the end of the text."""
        place, k, start = min(place, int(self.sums[1, 0]) - 1), 1, 0
        while k < self.width:
            left = int(self.sums[2 * k, 0])
            k, start = (2 * k, start) if place < start + left else (2 * k + 1, start + left)
        return k - self.width, start

    def put(self, leaf: int, characters: int, tokens: int) -> None:
        k = leaf + self.width
        change = np.array([characters, tokens]) - self.sums[k]
        while k and change.any():
            self.sums[k] += change
            k //= 2

    def edit(self, text: str, edits: list[tuple[int, int, str]], tokenizer: str) -> str:
        """Apply edits (start, end, replacement), sorted and apart, and return the new text.

        Each edit touches the leaves that hold it and a few characters on either
        side, since what stands beside an edit may fall into other tokens; edits
        that share a leaf share a region. Only regions are encoded again.
        """
        if not len(text):
            new = "".join(r for _, _, r in edits)
            self.sums = TokenTree.of(new, tokenizer).sums
            self.width, self.encoded = len(self.sums) // 2, self.encoded + len(new)
            return new
        regions: list[list] = []  # first leaf, last leaf, edits
        for a, b, r in edits:
            first, last = self.leaf(max(0, a - _MARGIN))[0], self.leaf(b + _MARGIN)[0]
            if regions and first <= regions[-1][1]:
                regions[-1][1] = max(last, regions[-1][1])
                regions[-1][2].append((a, b, r))
            else:
                regions.append([first, last, [(a, b, r)]])
        out, at = [], 0
        starts = np.concatenate([[0], np.cumsum(self.sums[self.width :, 0])]).tolist()
        for first, last, some in regions:
            lo, hi = starts[first], starts[last + 1]
            new, x = [], lo
            for a, b, r in some:
                new += [text[x:a], r]
                x = b
            said = "".join([*new, text[x:hi]])
            out += [text[at:lo], said]
            at = hi
            cuts = safe_cuts(said)
            leaves = last - first + 1
            bounds = [0, *cuts[np.linspace(0, len(cuts), leaves + 1).astype(int)[1:-1].clip(0, len(cuts) - 1)].tolist(), len(said)] if len(cuts) >= leaves > 1 else [0] + [len(said)] * leaves
            for k, (lo_, hi_) in enumerate(zip(bounds, bounds[1:], strict=False)):
                self.put(first + k, hi_ - lo_, len(pretokens.ids(said[lo_:hi_], tokenizer)) if hi_ > lo_ else 0)
            self.encoded += len(said)
        return "".join([*out, text[at:]])


def edits_of(text: str, pattern: re.Pattern, replacement: str) -> list[tuple[int, int, str]]:
    """Every match that isn't empty, in order, with what takes its place: one pass over the text."""
    return [(m.start(), m.end(), replacement) for m in pattern.finditer(text) if m.end() > m.start()]


def with_edits(docs: DataFrame, pattern: str, replacement: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and edits: every match of ``pattern`` (of Python's ``re``) becomes ``replacement``.

    Places are in code points. Null text is empty; a null id stays null; repeated rows get a row each.
    """
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = re.compile(pattern)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        for b in batches:
            edits = [[{"start": x, "end": y, "text": r} for x, y, r in edits_of(t, found, replacement)] for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(edits, kind)], names=["doc_id", "text", "edits"])

    return docs.mapInArrow(run, f"doc_id long, text string, edits {_EDITS}")


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", *, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """doc_id, text, edits, n_tokens and tree (binary) of each row; without a shuffle.

    Null text is empty, null edits are none; a null id stays null; repeated rows
    get a row each; an empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), docs[edits_col].cast(_EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            trees = [TokenTree.of(t, tokenizer) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([t.tokens for t in trees], pa.int64()), pa.array([t.sums.astype("<i4").tobytes() for t in trees], pa.binary())], names=[*b.schema.names, "n_tokens", "tree"])

    return docs.mapInArrow(run, f"doc_id long, text string, edits {_EDITS}, n_tokens long, tree binary")


def apply_edits(trees: DataFrame, *, tokenizer: str = "byte_bpe_50k", texts: bool = False) -> DataFrame:
    """Counts after the edits, from the kept trees: only what edits touch is encoded.

    Per row: doc_id, n_tokens, n_edits, n_tokens_after, n_chars_after,
    n_chars_encoded; with ``texts`` the edited text and its tree too, ready for
    further edits. Edits are sorted and do not overlap; rows as in ``build``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in range(6)]
            for text, edits, raw in zip(texts_of(b.column(1)), b.column(2).to_pylist(), b.column(4).to_pylist(), strict=True):
                tree, edits = TokenTree(np.frombuffer(raw, "<i4").reshape(-1, 2).astype(np.int64)), edits or []
                if edits:
                    text = tree.edit(text, [(e["start"], e["end"], e["text"] or "") for e in edits], tokenizer)
                for column, x in zip(rows, (len(edits), tree.tokens, len(text), tree.encoded, text, tree.sums.astype("<i4").tobytes()), strict=True):
                    column.append(x)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = [b.column(0), b.column(3), *[pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]]
            n = 8 if texts else 6
            yield pa.RecordBatch.from_arrays(columns[:n], names=[*_COUNTS, "text", "tree"][:n])

    out = ", ".join(f"{c} long" for c in _COUNTS) + ", text string, tree binary" * texts
    return trees.select("doc_id", "text", "edits", "n_tokens", "tree").mapInArrow(run, out)


def count_edited(docs: DataFrame, pattern: str, replacement: str, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """What ``apply_edits(build(with_edits(...)))`` gives, with trees that live in the task only.

    For counts that are wanted once: text, edits and trees don't leave the
    worker that reads the text. Rows as in ``build``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = re.compile(pattern)
        for b in batches:
            rows = []
            for text in texts_of(b.column(1)):
                tree, edits = TokenTree.of(text, tokenizer), edits_of(text, found, replacement)
                before = tree.tokens
                if edits:
                    text = tree.edit(text, edits, tokenizer)
                rows.append((before, len(edits), tree.tokens, len(text), tree.encoded))
            columns = np.array(rows, np.int64).reshape(-1, len(_COUNTS) - 1).T
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, columns)], names=_COUNTS)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(run, ", ".join(f"{c} long" for c in _COUNTS))
