"""Runs of periodic words: every maximal stretch that repeats with some period, found in an enhanced suffix array.

A run of period q ends with a square, q words twice, whose next word breaks the period. Its two halves start suffixes with
exactly q words in common, so they lie in different children of the LCP interval of depth q. For each interval the suffixes
of the smaller children look up, in the inverse suffix array, whether the suffix q words on or back lies in the other
children; every such branching square is rotated to the left as far as it goes, and squares of one stretch are merged into
the run of its smallest period. Suffixes of different texts share nothing, so many texts are worked on at once, and all
steps are array operations: no tree and no step for a single word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from txguard.llm import textarrays as ta

LEAST, TIMES = 24, 3  # a run has so many words, and so many periods, at least
PROBES = 1 << 21  # look-ups done at once

# Fixed value: the bytes that part words.
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes put together, their lengths, and for each text the index of its first word (and the end)."""
    inside = ~SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    starts[first] = inside[first]
    at = np.flatnonzero(starts)
    packed = np.concatenate([[0], np.cumsum(inside)])
    ends = np.append(packed[at[1:]], packed[-1]) if len(at) else np.zeros(0, np.int64)
    return data[inside], ends - packed[at], np.searchsorted(at, offsets)


def numbers(packed: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words."""
    where = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(where), pa.py_buffer(np.ascontiguousarray(packed))])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


class SuffixArray:
    """Suffixes in order, with the ranks of their prefixes of 1, 2, 4, ... words, which tell common lengths either way.

    ``order`` is the suffix array, ``rank`` its inverse, ``common`` the words that a suffix shares with the one in front of
    it. Only suffixes that still share their prefix are sorted again. Memory: four bytes a word for each doubling up to the
    longest repeat, of the texts at hand.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = len(words)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.ends, self.starts = bounds[1:][text], bounds[:-1][text]
        key = text * (int(words.max(initial=0)) + 1) + words
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, bool)  # is the suffix here the first of its rank?
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        self.levels, step = [rank], 1
        while True:
            again = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
            if not len(again):
                break
            i = order[again]
            then = np.where(i + step < self.ends[i], rank[np.minimum(i + step, n - 1)].astype(np.int64), -1)
            both = rank[i].astype(np.int64) * (n + 1) + then + 1
            turn = np.argsort(both, kind="stable")
            i, both = i[turn], both[turn]
            order[again] = i
            new = np.ones(len(again), bool)
            new[1:] = both[1:] != both[:-1]
            fresh[again] = new
            rank = rank.copy()
            rank[i] = again[np.maximum.accumulate(np.where(new, np.arange(len(again)), 0))]
            self.levels.append(rank)
            step *= 2
        self.order, self.rank = order, rank
        self.common = np.zeros(n, np.int64)
        alike = np.flatnonzero(self.levels[0][order[1:]] == self.levels[0][order[:-1]]) + 1
        self.common[alike] = self.ahead(order[alike - 1], order[alike])

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` have in common."""
        length, last = np.zeros(len(a), np.int64), len(self.ends) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + length, b + length
            inside = (x < self.ends[a]) & (y < self.ends[b])
            ranks = self.levels[k]
            length += np.where(inside & (ranks[np.minimum(x, last)] == ranks[np.minimum(y, last)]), 1 << k, 0)
        return length

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words right before ``a`` and ``b``, two places of one text."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - length - (1 << k), b - length - (1 << k)
            inside = (x >= self.starts[a]) & (y >= self.starts[a])
            ranks = self.levels[k]
            length += np.where(inside & (ranks[np.maximum(x, 0)] == ranks[np.maximum(y, 0)]), 1 << k, 0)
        return length

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(at, low, high)``: the suffixes ``low..at-1`` and ``at..high-1`` are children of an interval of depth ``common[at]``.

        An interval with more children comes as several such parts, so that each two children meet in one of them. The bounds
        are the nearest smaller entries, found by jumping over those that are known to be larger.
        """
        n = len(self.common)
        depth = np.append(self.common, -1)
        depth[0] = -1
        before, after = np.arange(-1, n), np.arange(1, n + 2)
        todo = np.flatnonzero(self.common > 0)
        at = todo
        while len(todo):
            todo = todo[depth[before[todo]] >= depth[todo]]
            before[todo] = before[before[todo]]
        todo = at
        while len(todo):
            todo = todo[depth[after[todo]] > depth[todo]]
            after[todo] = after[after[todo]]
        return at, before[at], after[at]

    def branching_squares(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts and periods of the squares that the next word breaks, some at a time."""
        at, low, high = self.spans()
        left = at - low <= high - at
        first, size = np.where(left, low, at), np.where(left, at - low, high - at)
        done = np.concatenate([[0], np.cumsum(size)])
        n, part = len(self.order), 0
        while part < len(at):
            end = max(part + 1, int(np.searchsorted(done, done[part] + PROBES, "right")) - 1)
            sizes = size[part:end]
            node = np.repeat(np.arange(part, end), sizes)
            place = np.arange(len(node)) - np.repeat(done[part:end] - done[part], sizes) + first[node]
            i, depth = self.order[place], self.common[at[node]]
            other_low, other_high = np.where(left, at, low)[node], np.where(left, high, at)[node]
            for j in (i + depth, i - depth):
                rank = self.rank[np.clip(j, 0, n - 1)]
                hit = (j >= 0) & (j < n) & (rank >= other_low) & (rank < other_high)
                yield np.minimum(i, j)[hit], depth[hit]
            part = end


def runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES):
    """``(text, start, length, period)`` of the runs of each text, by text, start and period; starts count from the text's own."""
    found = [np.zeros((0, 3), np.int64)]
    if len(words):
        array = SuffixArray(words, bounds)
        for start, period in array.branching_squares():
            end = start + 2 * period
            start = start - array.behind(start, start + period)
            long = end - start >= np.maximum(least, times * period)
            found.append(np.stack([start[long], end[long], period[long]], 1))
    every = np.unique(np.concatenate(found), axis=0)  # by start, end and period: the smallest period of a stretch comes first
    fresh = np.ones(len(every), bool)
    fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    start, end, period = every[fresh].T
    turn = np.lexsort((period, start))
    start, end, period = start[turn], end[turn], period[turn]
    text = np.searchsorted(bounds, start, "right") - 1
    return text, start - bounds[text], end - start, period


def collapse(packed: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, found) -> list[bytes]:
    """The texts' words, joined by a space, without those that a run contains after its first period."""
    text, start, length, period = found
    cover = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(cover, bounds[text] + start + period, 1)
    np.add.at(cover, bounds[text] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
    sizes = lengths[kept]
    source = np.concatenate([[0], np.cumsum(lengths)])[kept]
    target = np.concatenate([[0], np.cumsum(sizes + 1)])  # a space behind each word
    out = np.full(int(target[-1]), 0x20, np.uint8)
    step = np.arange(int(sizes.sum())) - np.repeat(np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
    out[np.repeat(target[:-1], sizes) + step] = packed[np.repeat(source, sizes) + step]
    edges = target[np.searchsorted(kept, bounds)]
    whole = out.tobytes()
    return [whole[a:max(a, b - 1)] for a, b in zip(edges[:-1], edges[1:])]


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest ratio of length to period, compared exactly; of equal ones the first."""
    best = None
    for run in found:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
ADDED = [("n_words", T.LongType()), ("runs", T.ArrayType(RUN)), ("strongest", RUN), ("collapsed", T.StringType())]


def _finder(text: str, names: list[str], least: int, times: int):
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in ta.chunks(batch.column(text)):
                packed, lengths, bounds = split(data, offsets)
                found = runs(numbers(packed, lengths), bounds, least, times)
                own: list[list[tuple[int, int, int]]] = [[] for _ in range(b - a)]
                for i, *run in zip(*(x.tolist() for x in found)):
                    own[i].append(tuple(run))
                named = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in own]
                best = [dict(zip(("start", "length", "period"), s)) if (s := strongest(rs)) else None for rs in own]
                columns = [
                    pa.array(np.diff(bounds), pa.int64()), pa.array(named, pa.list_(run_type)), pa.array(best, run_type),
                    pa.array(collapse(packed, lengths, bounds, found), pa.binary()).cast(pa.string())]
                kept = [batch.column(n).slice(a, b - a) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*names, *(n for n, _ in ADDED)])

    return work


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None, *, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The columns ``keep`` of ``docs`` (by default all; none may be named like a new one) with the runs of each whole text.

    ``n_words``; ``runs``, each with ``start`` (a word number from 0), ``length`` and ``period``, by start, then period;
    ``strongest``, the run with the most periods (of equal ones the first; null without runs); ``collapsed``, the words
    without the repeats, joined by one space. Null and empty texts have no words and no runs; repeated rows are judged one by
    one; an empty table gives an empty one. A text is worked on in one task; nothing is shuffled.
    """
    keep = docs.columns if keep is None else keep
    taken = {c.lower() for c in keep} & {n for n, _ in ADDED}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    rows = docs.select(*dict.fromkeys([*keep, text]))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in ADDED])
    return rows.mapInArrow(_finder(text, keep, least, times), schema)
