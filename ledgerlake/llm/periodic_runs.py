"""Runs of periodically repeated words, found with the dictionary of basic factors.

The words of a text are numbered from 0. A run is a stretch of consecutive words with smallest
period q (words q apart are equal) of at least ``least`` words and ``times`` periods that no
neighbouring word extends keeping period q.

For each power of two, l, the factors of l words are named: equal factors of a text have equal
names, and a factor of 2 l words is named by the names of its halves. Only factors that occur
again in their text are kept, so little is left beyond the first lengths in ordinary prose.
Successor occurrences of a factor at most 2 l apart propose their distance as a period; where
such pairs begin at one word after the other with the same distance (an arithmetic progression),
the first stands for all. A proposal is extended to both sides as far as words a period apart are
equal, and what is found more than once is kept once.

Every run is found. Let l be the least power of two that is not below q. The factor of l words at
the run's start occurs again q words later, as 3 q words hold both, and not in between: else a
factor of at least q words with period q had a smaller period that divides q, and so had the run.
No other period is returned: a stretch of three proposed periods d with a smaller period has one
that divides d, and then the successor would have stood nearer than d.

Null texts and such without words have no run; their collapsed text is empty. Texts have no
greatest length: memory grows with the longest text, by some hundred bytes a word. A null doc_id
is returned as it is, repeated rows are repeated, an empty table gives no row, other columns are
ignored. Nothing is shuffled; a lost task gives the same rows again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, spans_of_texts, whole_text

LEAST, TIMES = 24, 3
#: Steps by which all proposals of a length are extended together; what goes on is extended alone.
_TOGETHER = 16

_RUN = "struct<start: long, length: long, period: long>"
SCHEMA = f"doc_id long, runs array<{_RUN}>, strongest {_RUN}, collapsed string"


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _right_end(words: np.ndarray, at: int, period: int) -> int:
    """The first place from ``at`` on whose word differs from the one a period later."""
    block, limit = 64, len(words) - period
    while at < limit:
        stop = min(at + block, limit)
        differs = np.flatnonzero(words[at:stop] != words[at + period : stop + period])
        if len(differs):
            return at + int(differs[0])
        at, block = stop, min(2 * block, 1 << 20)
    return at


def _left_end(words: np.ndarray, at: int, period: int) -> int:
    """The least place from which on, up to ``at``, words equal those a period later."""
    block = 64
    while at > 0:
        begin = max(at - block, 0)
        differs = np.flatnonzero(words[begin:at] != words[begin + period : at + period])
        if len(differs):
            return begin + int(differs[-1]) + 1
        at, block = begin, min(2 * block, 1 << 20)
    return at


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, equal: int) -> Iterator[tuple[int, int, int]]:
    """(first place, end, period) of the stretches around proposals: the words from the first
    place to before the end equal those a period later. They do for ``equal`` words from ``at``."""
    left, right = at.copy(), at + equal
    active = np.arange(len(at))
    for _ in range(_TOGETHER):
        active = active[right[active] + period[active] < len(words)]
        active = active[words[right[active]] == words[right[active] + period[active]]]
        right[active] += 1
    rightwards = set(active.tolist())
    active = np.arange(len(at))
    for _ in range(_TOGETHER):
        active = active[left[active] > 0]
        active = active[words[left[active] - 1] == words[left[active] - 1 + period[active]]]
        left[active] -= 1
    leftwards = set(active.tolist())
    done: dict[int, int] = {}  # the end of the last stretch of a period, so that none is walked along twice
    for k, (begin, end, d) in enumerate(zip(left.tolist(), right.tolist(), period.tolist())):
        if begin < done.get(d, 0):
            continue
        if k in rightwards:
            end = _right_end(words, end, d)
        if k in leftwards:
            begin = _left_end(words, begin, d)
        done[d] = end
        yield begin, end, d


def runs_in(words: np.ndarray, document: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """The runs as rows (start, length, period) by start and period, places counted over all words.

    ``words`` are numbers from 0 on, those of several documents in a row with a word between two
    documents that occurs nowhere else; ``document`` rises with the document of each word.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not all found")
    size = len(words)
    runs: set[tuple[int, int, int]] = set()
    # Factors of one word, by word and place; those of different documents count as different.
    keys = np.sort(words.astype(np.int64) << 32 | np.arange(size))
    place, word = keys & 0xFFFFFFFF, keys >> 32
    same = (word[1:] == word[:-1]) & (document[place[1:]] == document[place[:-1]])
    length = 1
    while same.any():
        distance = place[1:][same] - place[:-1][same]
        near = (2 * distance > length) & (distance <= 2 * length)
        at, distance = place[:-1][same][near], distance[near]
        order = np.argsort(at)
        at, distance = at[order], distance[order]
        goes_on = np.zeros(len(at), bool)
        goes_on[1:] = (at[1:] == at[:-1] + 1) & (distance[1:] == distance[:-1])
        for begin, end, period in _extended(words, at[~goes_on], distance[~goes_on], length):
            if end - begin + period >= max(least, times * period):
                runs.add((begin, end - begin + period, period))
        # Names for the factors that occur again, then those of twice the length.
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        names = np.full(size, -1, np.int64)
        names[place[again]] = np.concatenate([[0], np.cumsum(~same)])[again]
        halves = np.sort(place[again])
        halves = halves[halves + length < size]
        halves = halves[names[halves + length] >= 0]
        pairs = names[halves] * size + names[halves + length]
        order = np.argsort(pairs, kind="stable")
        place, pairs = halves[order], pairs[order]
        same = pairs[1:] == pairs[:-1]
        length *= 2
    return np.array(sorted(runs, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of most periods, exactly compared; the first of equals by start, then period."""
    best = runs[0]
    for run in runs[1:]:
        ahead = run[1] * best[2] - best[1] * run[2]
        if ahead > 0 or (ahead == 0 and (run[0], run[2]) < (best[0], best[2])):
            best = run
    return best


def _structs(rows: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(rows[:, k]), pa.int64()) for k in range(3)], names=["start", "length", "period"]
    )


def _documents(texts: list[bytes], least: int, times: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    numbers = _Numbers()
    split = [text.split() for text in texts]
    total = sum(map(len, split))
    words = np.empty(total + len(texts), np.int64)
    document = np.repeat(np.arange(len(texts)), [len(s) + 1 for s in split])
    first, at = [], 0
    for k, some in enumerate(split):
        first.append(at)
        words[at : at + len(some)] = np.fromiter(map(numbers.__getitem__, some), np.int64, len(some))
        at += len(some)
        words[at] = total + k  # ends the text: no word has this number
        at += 1
    runs = runs_in(words, document, least, times)
    ends = np.searchsorted(document[runs[:, 0]], np.arange(len(texts) + 1))
    best, collapsed = [], []
    for k, some in enumerate(split):
        of_text = runs[ends[k] : ends[k + 1]]
        if not len(of_text):
            best.append(None)
            collapsed.append(b" ".join(some).decode())
            continue
        of_text[:, 0] -= first[k]
        kept = np.ones(len(some), bool)
        for start, length, period in of_text.tolist():
            kept[start + period : start + length] = False
        start, length, period = strongest([tuple(r) for r in of_text.tolist()])
        best.append({"start": start, "length": length, "period": period})
        collapsed.append(b" ".join(compress(some, kept.tolist())).decode())
    kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    return (
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _structs(runs)),
        pa.array(best, kind),
        pa.array(collapsed, pa.string()),
    )


def found(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, runs, strongest, collapsed.

    ``runs`` holds start, length and period by start, then period; ``strongest`` is the run of
    most periods, null if there is none; ``collapsed`` has the words that no run holds after its
    first period, joined by one space.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).to_pylist()
        for begin, end in spans_of_texts(texts):
            columns = _documents(texts[begin:end], least, times)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, end - begin), *columns], ["doc_id", "runs", "strongest", "collapsed"]
            )

    bytes_of = whole_text().cast("binary")
    return map_arrow(docs.select(F.col("doc_id").cast("long"), bytes_of.alias("text")), run, SCHEMA)
