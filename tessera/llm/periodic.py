"""Runs of periodic words in whole texts, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q and a length of at least
max(LEAST, TIMES * q) that no neighbouring word extends.  Each word of a run recurs in it at least
TIMES times.  So, in each text:

1. a word that the current segment holds less than TIMES times is in no run there: it splits the
   segment; pieces shorter than LEAST go, and pieces that changed are split again, until none
   does.  Most texts have nothing left here;
2. the surviving segments are scanned by lag.  A word equals the word q later all along a run.  The lags to
   scan come from the words themselves: for every power of two k, groups of k words whose next
   equal group is q words on, with k / 2 < q <= k, all along a stretch.  Every run shows one (two equal groups of q
   words less than q apart would have a smaller period), so no lag is missed and few are
   scanned; each proposal is scanned word by word to both sides, and dropped if a divisor of its lag is a period too.

No row leaves its task and nothing is shuffled.  A text's work is about its length times the
square of the logarithm of its longest segment.

Defined results: words are the parts between ASCII white space; a null, empty or blank text has none
and no run; repeated rows get equal results; an empty table gives no rows; other columns are
carried along, but for those named like the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import short_batches, small, then_give_back
from tessera.llm.rolling import mixed

LEAST = 24
TIMES = 3
RESULTS = ("n_words", "runs", "strongest", "collapsed")


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), "i8", len(words))


def surviving(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """The segments (from, to) left by splitting at words that are too rare in their segment, to stability."""
    done, open_ones = [], [(0, len(ids))] if len(ids) >= least else []
    while open_ones:
        # one round for all open segments: places, the segment of each, and counts by (segment, word)
        starts = np.array([s for s, _ in open_ones])
        sizes = np.array([e - s for s, e in open_ones])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner]
        _, back, count = np.unique(owner * (int(ids.max()) + 1) + ids[place], return_inverse=True, return_counts=True)
        rare = count[back] < times
        split = np.zeros(len(sizes), bool)
        split[owner[rare]] = True
        done += [open_ones[i] for i in np.flatnonzero(~split).tolist()]
        # stretches of kept words in the segments that were split
        kept = ~rare & split[owner]
        edge = np.flatnonzero(np.concatenate(([True], (kept[1:] != kept[:-1]) | (owner[1:] != owner[:-1]), [True])))
        pieces = [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if b - a >= least and kept[a]]
        open_ones = [(int(place[a]), int(place[b - 1]) + 1) for a, b in pieces]
    return sorted(done)


def following(groups: np.ndarray) -> np.ndarray:
    """Distance of each group's hash to the next equal one (0: there is none)."""
    order = np.argsort(groups, kind="stable")
    out = np.zeros(len(groups), "i8")
    same = np.flatnonzero(groups[order[1:]] == groups[order[:-1]])
    out[order[same]] = order[same + 1] - order[same]
    return out


def _reach(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch (from, to) around ``at`` where each word equals the one ``lag`` later, both included."""
    n, step, left, right = len(ids), 64, at, at
    while right < n - lag:  # to the right, in blocks that double
        end = min(n - lag, right + step)
        apart = np.flatnonzero(ids[right:end] != ids[right + lag:end + lag])
        if len(apart):
            right += int(apart[0])
            break
        right, step = end, step * 2
    step = 64
    while left > 0:
        begin = max(0, left - step)
        apart = np.flatnonzero(ids[begin:left] != ids[begin + lag:left + lag])
        if len(apart):
            left = begin + int(apart[-1]) + 1
            break
        left, step = begin, step * 2
    return left, right + lag


def primitive(block: np.ndarray) -> bool:
    """False if ``block`` is a shorter block several times over."""
    q, rest, p = len(block), len(block), 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            while rest % p == 0:
                rest //= p
            if (block[q // p:] == block[:-(q // p)]).all():
                return False
        p += 1
    return True


def scanned(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment."""
    found = set()
    n, k = len(ids), 1
    groups = mixed(ids.astype("u8") + np.uint64(1))
    while True:
        next_one = following(groups)
        edge = np.flatnonzero(np.concatenate(([True], next_one[1:] != next_one[:-1], [True])))
        lag, wide = next_one[edge[:-1]], np.diff(edge)
        # a run of period q shows (length - q - k + 1) such groups in a row
        shown = (lag > k // 2) & (lag <= k) & (wide >= np.maximum(least, times * lag) - lag - k + 1)
        for at, q in zip(edge[:-1][shown].tolist(), lag[shown].tolist(), strict=True):
            start, end = _reach(ids, at, q)
            if end - start >= max(least, times * q):
                found.add((start, end - start, q))
        if k * times > n or len(groups) <= k:
            break
        # groups of twice as many words; half of the lags up to 2k end at k words or more
        groups = mixed(groups[:-k] * np.uint64(3) + groups[k:])
        k *= 2
    return [r for r in found if primitive(ids[r[0]:r[0] + r[2]])]


def runs(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    if len(words) < least:
        return []
    ids = numbered(words)
    return sorted((a + s, n, q) for a, b in surviving(ids, least, times) for s, n, q in scanned(ids[a:b], least, times))


def kept(count: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """False for each word that a run holds after its first period."""
    out = np.ones(count, bool)
    for start, length, period in found:
        out[start + period:start + length] = False
    return out


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the least start, then period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def collapse(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` without ``text`` and with ``n_words``, ``runs`` (by start and period), ``strongest`` (null: no run)
    and ``collapsed``: the words that stay, joined by one space (never null)."""
    names = RESULTS
    keep = [f for f in docs.schema.fields if f.name != text and f.name.lower() not in names]
    carried = [f"c{i}" for i in range(len(keep))]
    made = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("strongest", RUN),
            T.StructField("collapsed", T.StringType())]
    run_type = pa.struct([(n, pa.int64()) for n in RUN.names])

    def of(value: str | None) -> tuple:
        words = (value or "").encode().split()
        count, found = len(words), runs(words, least, times)
        if found:
            words = [words[i] for i in np.flatnonzero(kept(len(words), found)).tolist()]
        best = strongest(found)
        as_row = lambda r: dict(zip(RUN.names, r, strict=True))
        return count, [as_row(r) for r in found], best and as_row(best), b" ".join(words).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 256):
            columns = zip(*[of(v.as_py()) for v in batch.column("text")], strict=True)
            kinds = (pa.int64(), pa.list_(run_type), run_type, pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                                             [*carried, *names])

    given = short_batches(docs).select(*[F.col(f"`{f.name}`").alias(c) for c, f in zip(carried, keep, strict=True)], F.col(text).alias("text"))
    schema = T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(carried, keep, strict=True)], *made])
    return given.mapInArrow(then_give_back(run), schema).select(*[F.col(c).alias(f.name) for c, f in zip(carried, keep, strict=True)], *names)
