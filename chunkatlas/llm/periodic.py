"""Runs of repeated words: stretches with a smallest period, found by last occurrences in a suffix automaton.

The automaton of a word sequence is built, and its link tree is then visited prefix by prefix. Visiting the
state of the prefix that ends at word i is the access of a link-cut tree: the path from the root to the state is
coloured i, and the segments of other colours on it are given up. A segment coloured j whose deepest state has
length l says that the l words that end at i occurred last at j. With p = i - j <= l the last 2p words are a
square of period p; the same words reach back to i - l - p + 1 and no further, and where word i + 1 differs from
word i + 1 - p, they reach no further on either. A shorter period would have given a later last occurrence, so
p is the smallest. Since the tree is complete before the first visit, no link is cut; the paths are kept as
stacks of segments on heavy paths, which makes a visit O(log n) amortised as with the usual auxiliary trees.

Only stretches that can hold runs go through the automaton. Every m-word window of a run occurs twice in it (m
follows from the wanted least length and exponent), so a run lies in a stretch of neighbouring windows that all
repeat within the stretch. Windows are compared by 64-bit hashes: equal hashes of different windows only make the
automaton read more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import _MULTIPLIERS, _ODD, mix, slices, word_hashes

LEAST = 6
TIMES = 4
#: Rows that are in Python at once.
_ROWS = 512
#: Passes of the filter; more passes leave less to the automaton, none changes the result.
_PASSES = 6
_U = np.uint64
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

SCHEMA = "key bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def automaton(words: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of the states, and the state of each prefix."""
    step: list[dict[int, int]] = [{}]
    link, length, ends = [-1], [0], []
    last = 0
    for i, word in enumerate(words):
        now = len(step)
        step.append({})
        link.append(0)
        length.append(i + 1)
        ends.append(now)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = now
            p = link[p]
        if p >= 0:
            q = step[p][word]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[now] = clone
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = clone
                    p = link[p]
        last = now
    return link, length, ends


def _heavy_tops(link: list[int], length: list[int]) -> list[int]:
    """For each state the uppermost state of its heavy path."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    size, heavy, best = [1] * len(link), [-1] * len(link), [0] * len(link)
    for v in reversed(order[1:]):
        up = link[v]
        size[up] += size[v]
        if size[v] > best[up]:
            best[up], heavy[up] = size[v], v
    top = list(range(len(link)))
    for v in order[1:]:
        if heavy[link[v]] == v:
            top[v] = top[link[v]]
    return top


def find_runs(words: Sequence[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``times`` periods (2 or more), sorted."""
    link, length, ends = automaton(words)
    top = _heavy_tops(link, length)
    # Per heavy path its segments (length of the deepest state, last end), the uppermost segment last.
    segments: list[list[tuple[int, int]]] = [[] for _ in link]
    found, n = [], len(words)
    for i, state in enumerate(ends):
        seen, v = -1, state
        while v > 0:
            path, cut, above = segments[top[v]], length[v], -1
            while path:
                reach, j = path[-1]
                if above < 0:
                    above = j
                # A colour that goes on below has been met there at its full depth.
                if j > seen:
                    p, l = i - j, min(reach, cut)
                    if (l >= (times - 1) * p and l + p >= least
                            and (i + 1 == n or words[i + 1] != words[i + 1 - p])):
                        found.append((i - l - p + 1, l + p, p))
                if reach > cut:
                    break
                path.pop()
            path.append((cut, i))
            seen = max(seen, above)
            v = link[top[v]]
    return sorted(found, key=lambda run: (run[0], run[2]))


def window_length(least: int, times: int) -> int:
    """The longest window of which every run holds each of its windows twice."""
    return min(max(least, times * q) + 1 - 2 * q for q in range(1, least // times + 3))


def stretches(hashes: np.ndarray, edges: np.ndarray, m: int) -> list[tuple[int, int]]:
    """Ranges of words outside which no run can be, none of them across the edges."""
    total = len(hashes) - m + 1
    if total <= 0:
        return []
    rolled = np.zeros(total, _U)
    for i in range(m):
        rolled += hashes[i:i + total] * _MULTIPLIERS[i]
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[:total]
    at = np.flatnonzero(np.arange(total) + m <= edges[1:][group])
    group = group[at]
    for _ in range(_PASSES):
        keys = mix(rolled[at] + mix(group.astype(_U) * _U(_ODD)))
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        if twice.all():
            break
        at, group = at[twice], group[twice]
        if len(at):
            group = np.cumsum(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(group) != 0))))
    if not len(at):
        return []
    cuts = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(group) != 0), [True])))
    return [(int(at[a]), int(at[b - 1]) + m) for a, b in zip(cuts[:-1], cuts[1:])]


def _slice_rows(texts: list[bytes], places: list[np.ndarray | None], least: int, times: int):
    """Per text its number of words, runs and remaining words."""
    hashes, edges = word_hashes(texts, lower=False)
    if any(p is not None for p in places):
        hashes = np.concatenate([hashes[lo:hi] if p is None else hashes[lo:hi][p]
                                 for lo, hi, p in zip(edges[:-1], edges[1:], places)])
    ranges = iter([*stretches(hashes, edges, window_length(least, times)), (len(hashes), 0)])
    lo, hi = next(ranges)
    for text, place, first, end in zip(texts, places, edges[:-1].tolist(), edges[1:].tolist()):
        words = text.split()
        if place is not None:
            words = [words[i] for i in place.tolist()]
        runs = []
        while lo < end:
            part = words[lo - first:hi - first]
            numbers: dict[bytes, int] = {}
            found = find_runs([numbers.setdefault(w, len(numbers)) for w in part], least, times)
            runs += [(start + lo - first, length, period) for start, length, period in found]
            lo, hi = next(ranges)
        if runs:
            runs.sort(key=lambda run: (run[0], run[2]))
            # Words gone per position, as a running sum of where spans begin and end.
            change = np.zeros(len(words) + 1, np.int64)
            for start, length, period in runs:
                change[start + period] += 1
                change[start + length] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        yield end - first, runs, b" ".join(words)


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES,
                  order: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """key, n_words, runs and the text with each run cut down to its first period, for every row.

    Words are whatever lies between 0x20 and 0x09-0x0D; ``collapsed`` joins those that no run drops by one space.
    ``order`` may give, for a key and a number of words, the numbers of the words to read in their place. Null and
    empty texts have no words, no runs and an empty ``collapsed``. Rows are handled one by one: null or repeated keys
    stay rows of their own, equal texts have equal runs, other columns are not read, whatever their names. A
    task holds a slice of about 1 MB of texts, or one longer text with the automaton of its repetitive stretches.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                keys = part.column(0).to_pylist()
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                for lo, hi in slices(texts):
                    some = texts[lo:hi]
                    places = [order(k, len(t.split())) if order else None for k, t in zip(keys[lo:hi], some)]
                    rows = list(_slice_rows(some, places, least, times))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[lo:hi], pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
                         pa.array([[dict(zip(("start", "length", "period"), x)) for x in r[1]] for r in rows], pa.list_(_RUN)),
                         pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())],
                        ["key", "n_words", "runs", "collapsed"])

    picked = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return picked.mapInArrow(run, SCHEMA).withColumnRenamed("key", key)
