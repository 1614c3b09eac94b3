"""Runs of repeated word sequences: maximal pairs of an LCP-interval tree."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitmark.llm.common import texts_of

#: Words that are searched together; a longer text is searched alone.
_TOGETHER = 1 << 20
_NEVER = np.int64(1) << 60

Run = tuple[int, int, int]


def _least(period: int, length: int, times: int) -> int:
    """The fewest words that repeat the word one period before them in a run."""
    return max(length - period, (times - 1) * period)


def _distance_back(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How far back the same word stands in the same text."""
    key = doc * (np.int64(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    back = np.full(len(ids), _NEVER)
    same = key[order[1:]] == key[order[:-1]]
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    return back


def _may_repeat(back: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, times: int) -> np.ndarray:
    """Marks the words in whose stretch a run may lie; every run and both its neighbours are marked.

    In a run of period q, each word after the first q has its like at most q
    back. So for periods from s to 2s - 1, only stretches of enough words with
    their like less than 2s back are of interest. ``first`` and ``last`` bound the text of each word.
    """
    edges = np.zeros(len(back) + 1, np.int64)
    s, longest = 1, int((last - first).max())
    while _least(s, length, times) <= longest:
        need = min(_least(q, length, times) for q in range(s, min(2 * s, s + length)))
        near = np.concatenate([[0], (back < 2 * s).view(np.int8), [0]])
        at = np.flatnonzero(np.diff(near))
        starts, stops = at[::2], at[1::2]
        long = stops - starts >= need
        starts, stops = starts[long], stops[long]
        np.add.at(edges, np.maximum(starts - 2 * s, first[starts]), 1)
        np.add.at(edges, np.minimum(stops + 1, last[starts]), -1)
        s *= 2
    return np.cumsum(edges[:-1]) > 0


def _suffixes(rank: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order and the ranks of their first 1, 2, 4 ... words, by prefix doubling.

    ``stop`` is where the region of each word ends; words of two regions are
    never equal. Only suffixes that still share a rank are sorted again.
    """
    n = len(rank)
    levels, step = [rank], 1
    tied = np.arange(n)
    while True:
        sizes = np.bincount(rank, minlength=n)
        tied = tied[sizes[rank[tied]] > 1]
        if not len(tied):
            return np.argsort(rank), levels
        ahead = tied + step
        following = np.where(ahead < stop[tied], rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.lexsort((following, rank[tied]))
        tied, following = tied[order], following[order]
        old = rank[tied]
        new_group = np.concatenate([[True], (old[1:] != old[:-1]) | (following[1:] != following[:-1])])
        new_rank = np.concatenate([[True], old[1:] != old[:-1]])
        place = np.arange(len(tied))
        begins = np.maximum.accumulate(np.where(new_rank, place, 0))  # of the old group
        offset = np.maximum.accumulate(np.where(new_group, place, 0)) - begins
        rank = rank.copy()
        rank[tied] = old + offset
        levels.append(rank)
        step *= 2


def _heights(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words each suffix shares with the one before it in order."""
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ranks = np.append(levels[k], [-1, -2])
        same = (ranks[a] == ranks[b]).astype(np.int64) << k
        a, b, shared = a + same, b + same, shared + same
    return np.concatenate([[0], shared])


class _Pairs:
    """Maximal pairs of one set of suffixes, each no farther apart than its length over ``times`` - 1."""

    def __init__(self, left: list[int], times: int):
        self.left, self.part, self.found = left, times - 1, {}

    def join(self, a: list[int], b: list[int], height: int) -> list[int]:
        """Places of two children of an interval of ``height``: pairs between them with unlike left words are maximal.

        Places so near each other lie in one progression, as what stands there
        repeats itself; all but its first have the same left word. So from each
        place of the smaller list, the class of left words is looked up at the
        first place of the other list that is near enough on its left, and at
        those on its right until a left word is the same.
        """
        if len(a) > len(b):
            a, b = b, a
        far, left = height // self.part, self.left
        for p in a:
            at = bisect_left(b, p - far)
            if at < len(b) and b[at] < p and left[b[at]] != left[p]:
                self.pair(b[at], p, height)
            at = bisect_right(b, p)
            while at < len(b) and b[at] <= p + far and left[b[at]] != left[p]:
                self.pair(p, b[at], height)
                at += 1
        if len(a) * 16 < len(b):
            for p in a:
                insort(b, p)
        else:
            b = b + a
            b.sort()
        return b

    def pair(self, i: int, j: int, height: int) -> None:
        """A run from i: of pairs with the same ends the smallest distance is the period."""
        ends = i, j + height
        self.found[ends] = min(self.found.get(ends, j - i), j - i)

    def walk(self, places: list[int], heights: list[int]) -> None:
        """The LCP-interval tree of suffixes in order, bottom up; ``heights[k]`` is what places k - 1 and k share."""
        open_: list[tuple[int, list[int]]] = []  # intervals from the root down: height, places in order of the text
        for k, place in enumerate(places):
            height, some = heights[k + 1] if k + 1 < len(places) else 0, [place]
            while open_ and open_[-1][0] > height:
                over, others = open_.pop()
                some = self.join(others, some, over)
            if height and open_ and open_[-1][0] == height:
                some = self.join(open_.pop()[1], some, height)
            if height:
                open_.append((height, some))


def find_runs(ids: np.ndarray, bounds: np.ndarray, length: int = 6, times: int = 4) -> list[list[Run]]:
    """For each text the runs (start, length, period), by start, then period.

    ``ids`` are the words of all texts as numbers, text k from ``bounds[k]`` to
    ``bounds[k + 1]``. A run repeats itself with its smallest period for at least
    ``length`` words and ``times`` periods, and no neighbour extends it; ``times``
    is 4 or more, so that near places lie in one progression.

    Stretches in which no run can lie are left out first. Over the rest, two
    places whose suffixes share exactly L words and whose left words differ are
    a maximal pair; at distance d with L >= max(length - d, (times - 1) d) it is
    a run of L + d words, whose period is d unless a smaller one has the same ends.
    """
    if times < 4 or length < 1:
        raise ValueError("runs need four periods or more")
    found: list[list[Run]] = [[] for _ in range(len(bounds) - 1)]
    ids = np.asarray(ids, np.int64)
    if not len(ids):
        return found
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first, last = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    at = np.flatnonzero(_may_repeat(_distance_back(ids, doc), first, last, length, times))
    if not len(at):
        return found
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])])
    region = np.cumsum(new) - 1
    stop = np.append(np.flatnonzero(new)[1:], len(at))[region]
    key = region * (ids.max() + 1) + ids[at]
    ordered = np.sort(key)
    order, levels = _suffixes(np.searchsorted(ordered, key), stop)
    heights = _heights(order, levels)
    left = np.where(at > first[at], ids[at - 1], -1 - np.arange(len(at))).tolist()
    least = min(_least(q, length, times) for q in range(1, length + 1))
    high = heights >= least
    begins = np.flatnonzero(np.diff(np.concatenate([[0], high.view(np.int8), [0]])) == 1)
    ends = np.flatnonzero(np.diff(np.concatenate([[0], high.view(np.int8), [0]])) == -1)
    pairs = _Pairs(left, times)
    for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
        pairs.walk(order[b - 1 : e].tolist(), heights[b - 1 : e].tolist())
    for (i, j), period in pairs.found.items():
        if j - i >= length:
            k = int(at[i])
            found[doc[k]].append((k - int(first[k]), j - i, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in found]


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by single spaces, without those that any run holds after its first period."""
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 6, times: int = 4, reading: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and collapsed (text) of each row; without a shuffle.

    Words are what ASCII white space leaves between itself, numbered from 0, and
    equal if their bytes are. Runs are of ``find_runs``; ``collapsed`` keeps the
    first period of each. With ``reading``, the words of a row are those at the
    places that ``reading(id, number of words)`` gives, or all where it gives None.

    Null text is empty: no words, no runs, empty ``collapsed``; a null id stays
    null; repeated rows get a row each; an empty table gives no rows; other
    columns are ignored. A text and its words are held in one task, and time
    grows with the words as in a sort.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def searched(texts: list[list[bytes]]) -> list[list[Run]]:
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        words = pa.array([w for some in texts for w in some], pa.binary()).dictionary_encode()
        return find_runs(words.indices.to_numpy(), bounds, length, times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, runs, waiting, n = [], [], [], 0
            for i, text in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                if reading is not None and (places := reading(i, len(words))) is not None:
                    words = [words[k] for k in places.tolist()]
                if waiting and n + len(words) > _TOGETHER:
                    runs += searched(waiting)
                    waiting, n = [], 0
                waiting.append(words)
                texts.append(words)
                n += len(words)
            runs += searched(waiting)
            said = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in some] for some in runs], kind)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in texts], pa.int64()), said, pa.array([collapse(w, r) for w, r in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
