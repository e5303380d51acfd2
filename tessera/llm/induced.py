"""Suffix sorting by recursive induction, for one shard.

``sort`` orders all suffixes of an integer string.  Its queue is a bucket queue: one first-in
first-out run per leading symbol, all in one array.  Suffixes are pushed in the order of the
suffixes that induce them, so within a symbol the order of arrival is the order of the
suffixes, and popping the runs in symbol order pops the least suffix first.  The queue array is
a file once it exceeds ``MEMORY_BYTES`` (deleted before it is used, so that nothing stays behind);
it is read and appended to in blocks.  Leftmost-S substrings are named by one induction, the string of
their names is sorted by the same routine, and a second induction makes the order of all suffixes.

``sort_common`` carries common prefixes through that last induction.  Two suffixes that follow each
other in a run were pushed by two popped suffixes; they share one symbol more than the least
common prefix met between these two pops.  ``_Least`` keeps that least value for each symbol since
the last push to it.  Between the two kinds of suffixes of one run it is the shorter stretch of the
run's symbol.
"""

from __future__ import annotations

import tempfile

import numpy as np

from tessera.llm.rolling import Ranges, mixed

MEMORY_BYTES = 256 << 20
BLOCK = 1 << 18


def queue(size: int) -> np.ndarray:
    """An array of ``size`` empty places, in memory or in a file without a name."""
    if size * 8 <= MEMORY_BYTES:
        return np.full(size, -1, "i8")
    with tempfile.TemporaryFile() as file:
        file.truncate(size * 8)
        out = np.memmap(file, "i8", "r+", shape=size)
    for start in range(0, size, BLOCK):
        out[start:start + BLOCK] = -1
    return out


def _kinds(text: np.ndarray) -> np.ndarray:
    """True for each suffix that is less than the next one (the empty suffix is the least)."""
    n = len(text)
    up = np.zeros(n, bool)
    if n > 1:
        differs = np.flatnonzero(text[1:] != text[:-1])
        at = np.searchsorted(differs, np.arange(n))  # the next place where the text changes
        inner = at < len(differs)
        here = differs[at[inner]]
        up[inner] = text[here] < text[here + 1]
    return up


def _places(symbols: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """The places that pushes to ``symbols`` take, in order of arrival."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    count = np.arange(len(ranked))
    first = np.zeros(len(ranked), "i8")
    first[1:] = np.where(ranked[1:] != ranked[:-1], count[1:], 0)
    places = np.empty(len(symbols), "i8")
    places[order] = ends[ranked] + step * (count - np.maximum.accumulate(first))
    return places


class _Least:
    """By symbol, the least common prefix met since the last push to it (-1: no push yet)."""

    def __init__(self, symbols: int, limit: int):
        self.since = np.full(symbols, -1, "i8")
        self.limit = limit

    def pushed(self, met: np.ndarray, item: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Common prefix of each push with the push before it to its symbol (0: there is none).

        ``met[k]`` is the common prefix of the k-th pop with the pop before; ``item`` has the pops that push.
        """
        out = np.zeros(len(item), "i8")
        if len(item):
            order = np.argsort(symbols, kind="stable")
            ranked, at = symbols[order], item[order]
            head = np.concatenate(([True], ranked[1:] != ranked[:-1]))
            begin = np.zeros(len(at), "i8")
            begin[1:] = at[:-1] + 1
            begin[head] = 0
            padded = np.append(met, self.limit)
            low = np.minimum.reduceat(padded, np.stack([begin, at + 1], axis=1).ravel())[::2]
            before = self.since[ranked[head]]
            value = np.minimum(low + 1, self.limit)
            value[head] = np.where(before < 0, 0, np.minimum(np.minimum(before, low[head]) + 1, self.limit))
            out[order] = value
            last = np.flatnonzero(np.append(head[1:], True))
            rest = np.minimum.reduceat(padded, at[last] + 1)[np.arange(len(last))] if len(last) == 1 else np.array(
                [padded[x + 1:].min() for x in at[last].tolist()])
        known = self.since >= 0
        if len(met):
            self.since[known] = np.minimum(self.since[known], int(met.min()))
        if len(item):
            self.since[ranked[last]] = np.minimum(rest, self.limit)
        return out


def _met(text: np.ndarray, up: np.ndarray, stretch: np.ndarray, popped: np.ndarray, before: int, stored: np.ndarray) -> np.ndarray:
    """Common prefix of each popped suffix with the one popped before it: as stored, but nothing across
    runs and the shorter stretch between the two kinds of one run."""
    if not len(popped):
        return stored
    previous = np.concatenate(([before], popped[:-1]))
    out = stored.copy()
    other = up[popped] != up[previous]
    out[other] = np.minimum(stretch[popped[other]], stretch[previous[other]])
    out[text[popped] != text[previous]] = 0
    if before < 0:
        out[0] = 0
    return out


def _induce(text: np.ndarray, up: np.ndarray, bounds: np.ndarray, seeds: np.ndarray, common: np.ndarray | None = None,
            limit: int = 0) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, from the leftmost-S suffixes in order; with ``common`` (of each seed with the
    one before) also the common prefixes of neighbours, up to ``limit``.

    A block is popped at once.  What it pushes into itself ends it there: the pops before that
    place push nothing in front of it.
    """
    n, carry = len(text), common is not None
    order = queue(n)
    if carry:
        prefix, stretch = queue(n), _stretches(text, limit)
        least = _Least(len(bounds) - 1, limit)
    if len(seeds):  # to the ends of their runs, in order
        places = _places(text[seeds][::-1], bounds[1:] - 1, -1)
        order[places] = seeds[::-1]
        if carry:
            prefix[places] = common[::-1]
    heads = bounds[:-1].copy()
    order[heads[text[n - 1]]] = n - 1  # the last suffix follows the empty one
    heads[text[n - 1]] += 1
    if carry:
        least.since[text[n - 1]] = 0
    at, size, before = 0, BLOCK, -1
    while at < n:  # pop upwards; push the greater neighbours to the left
        end = min(n, at + size)
        left = order[at:end] - 1
        item = np.flatnonzero(left >= 0)
        item = item[~up[left[item]]]
        if len(item):
            left = left[item]
            symbols = text[left]
            places = _places(symbols, heads, 1)
            if (first := int(places.min())) < end:
                end = first
                item = item[:np.searchsorted(item, end - at)]
                left, symbols, places = left[:len(item)], symbols[:len(item)], places[:len(item)]
            order[places] = left
            heads[symbols] = places + 1  # of equal symbols the last one counts
        if carry:
            slot = np.flatnonzero(order[at:end] >= 0)
            popped = order[at:end][slot]
            met = _met(text, up, stretch, popped, before, prefix[at:end][slot])
            value = least.pushed(met, np.searchsorted(slot, item), text[popped[np.searchsorted(slot, item)] - 1] if len(item) else item)
            if len(item):
                prefix[places] = value
            before = int(popped[-1]) if len(popped) else before
        at, size = end, min(BLOCK, max(32, 2 * (end - at)))
    # the seeds go, and every S suffix is induced from the right
    for start in range(0, n, BLOCK):
        part = order[start:start + BLOCK]
        found = part >= 0
        found[found] = up[part[found]]
        part[found] = -1
    tails = bounds[1:] - 1
    if carry:
        least = _Least(len(bounds) - 1, limit)
    at, size, before, before_at = n, BLOCK, -1, -1
    while at > 0:
        begin = max(0, at - size)
        left = order[begin:at][::-1] - 1
        item = np.flatnonzero(left >= 0)
        item = item[up[left[item]]]
        if len(item):
            left = left[item]
            symbols = text[left]
            places = _places(symbols, tails, -1)
            if (last := int(places.max())) >= begin:
                begin = last + 1
                item = item[:np.searchsorted(item, at - begin)]
                left, symbols, places = left[:len(item)], symbols[:len(item)], places[:len(item)]
            order[places] = left
            tails[symbols] = places - 1
        if carry:
            slot = np.flatnonzero(order[begin:at][::-1] >= 0)
            popped = order[begin:at][::-1][slot]
            if len(popped):
                # what a suffix shares with the one popped before it, to its right, is kept with that one
                right = np.concatenate(([before_at], at - 1 - slot[:-1]))
                met = _met(text, up, stretch, popped, before, prefix[right])
                where = np.searchsorted(slot, item)
                value = least.pushed(met, where, text[popped[where] - 1] if len(item) else item)
                if len(item):
                    inner = value > 0
                    prefix[places[inner] + 1] = value[inner]
                before, before_at = int(popped[-1]), int(at - 1 - slot[-1])
        at, size = begin, min(BLOCK, max(32, 2 * (at - begin)))
    if not carry:
        return order
    for start in range(0, n, BLOCK):  # what stands between runs and kinds
        here = np.asarray(order[max(0, start - 1):start + BLOCK])
        got = prefix[max(0, start - 1):start + BLOCK]
        got[1 if start else 0:] = _met(text, up, stretch, here, -1, got)[1 if start else 0:]
    return order, prefix


def _stretches(text: np.ndarray, limit: int) -> np.ndarray:
    """How often the first symbol of each suffix follows itself, up to ``limit``."""
    change = np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, len(text))
    at = np.arange(len(text))
    return np.minimum(change[np.searchsorted(change, at, side="right")] - at, limit)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefixes of the suffixes at ``a`` and ``b``, up to ``limit``: by hashes of halving ranges."""
    ranges, out = Ranges(text), np.zeros(len(a), "i8")
    room = np.minimum(limit, len(text) - np.maximum(a, b))
    step = 1 << limit.bit_length()
    while step := step >> 1:
        can = np.flatnonzero(out + step <= room)
        left, right = a[can] + out[can], b[can] + out[can]
        same = ranges.of(left, left + step) == ranges.of(right, right + step)
        out[can[same]] += step
    return out


def sort(text: np.ndarray) -> np.ndarray:
    """The places of all suffixes of a non-empty array of small non-negative integers, in order."""
    if len(text) == 1:
        return np.zeros(1, "i8")
    up, bounds, marks = _marks(text)
    return _induce(text, up, bounds, marks)


def sort_common(text: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The order, and the common prefix of each suffix with the one before it, up to ``limit``."""
    if len(text) == 1:
        return np.zeros(1, "i8"), np.zeros(1, "i8")
    up, bounds, marks = _marks(text)
    return _induce(text, up, bounds, marks, np.concatenate((np.zeros(min(1, len(marks)), "i8"), _common(text, marks[:-1], marks[1:], limit))), limit)


def _marks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds of the suffixes, bounds of the runs, and the leftmost-S suffixes in order."""
    n = len(text)
    up = _kinds(text)
    bounds = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))))
    marks = np.flatnonzero(up[1:] & ~up[:-1]) + 1  # leftmost S
    if len(marks) > 1:
        rough = _induce(text, up, bounds, marks[np.argsort(text[marks], kind="stable")])
        is_mark = np.zeros(n, bool)
        is_mark[marks] = True
        ranked = np.concatenate([part[is_mark[part]] for part in (rough[s:s + BLOCK] for s in range(0, n, BLOCK))])
        del rough
        # equal substrings from mark to mark get one name: compared by two hashes, and by length
        following = np.empty(n, "i8")
        following[marks] = np.concatenate((marks[1:], [n - 1]))
        keys = _substring_keys(text, ranked, following[ranked])
        new = np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        last = ranked == marks[-1]  # it reaches the end: unlike any other
        new |= last
        new[1:] |= last[:-1]
        names = np.cumsum(new) - 1
        if names[-1] + 1 < len(marks):
            reduced = np.empty(n, "i8")
            reduced[ranked] = names
            marks = marks[sort(reduced[marks])]
        else:
            marks = ranked
    return up, bounds, marks


def _substring_keys(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(hash, hash, length) by column of the substrings from start to end, both included."""
    rows = []
    for base in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        power, inverse = (np.multiply.accumulate(np.concatenate((np.ones(1, "u8"), np.full(len(text), b, "u8"))))
                          for b in (base, pow(base, -1, 1 << 64)))
        total = np.concatenate((np.zeros(1, "u8"), np.cumsum(mixed(text.astype("u8") + np.uint64(1)) * power[:-1], dtype="u8")))
        rows.append((total[ends + 1] - total[starts]) * inverse[starts])
    return np.stack([*rows, (ends - starts).astype("u8")])


def repeats(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, group): every place whose ``length`` bytes stand at another place too, and the number
    of its group of equal strings."""
    text = np.frombuffer(data, "u1").astype("i8")
    if len(text) <= length:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    order, prefix = sort_common(text, length)
    return grouped(order, prefix, np.arange(len(text)) + length <= len(text), length)


def grouped(order: np.ndarray, prefix: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from an order and its common prefixes, over the places that are ``valid``."""
    group = np.cumsum(np.asarray(prefix) < length)  # a group ends where neighbours share less
    keep = valid[order]
    places, group = np.asarray(order)[keep], group[keep]
    count = np.bincount(group) if len(group) else group
    many = count[group] > 1
    return places[many], group[many]
