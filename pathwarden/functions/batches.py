"""Scores of many pairs of texts at once: a step of the comparison is one operation on whole columns of pairs."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

#: Pairs that advance together, and the cells of their tables.
PAIRS = 2_048
CELLS = 1_000_000
#: From this length on the matching-blocks ratio leaves out popular characters: such pairs are scored one by one.
LONG = 200
#: Characters at the edge of a common beginning or end that must not repeat near by, and the side of a small window.
EDGE = 4
SMALL = 16


def points(texts: list[str], filler: int) -> tuple[np.ndarray, np.ndarray]:
    """The characters of texts as numbers, one text a column, and their lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    width = max(1, int(sizes.max(initial=0)))
    found = np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width).copy()
    found[np.arange(width)[None, :] >= sizes[:, None]] = filler
    return np.ascontiguousarray(found.T), sizes


def _in_slices(a: list[str], b: list[str], compare) -> np.ndarray:
    """`compare` on slices of pairs, those of like lengths together."""
    total = np.zeros(len(a), np.int64)
    sizes = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b)), np.int64, len(a))
    order, low = np.argsort(-sizes, kind="stable"), 0
    while low < len(order):
        at = order[low : low + max(1, min(PAIRS, CELLS // (int(sizes[order[low]]) + 1)))]
        total[at] = compare([a[k] for k in at], [b[k] for k in at])
        low += len(at)
    return total


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """The Levenshtein distance of each pair, by the diagonals of its table."""

    def compare(left, right):
        (x, m), (y, n) = points(left, 0), points(right, 0)
        height, width, count = len(x), len(y), len(left)
        kind = np.uint8 if height + width < 250 else np.int32
        y = y[::-1]
        before, last, found = (np.zeros((height + 1, count), kind), np.zeros((height + 1, count), kind), np.zeros(count, np.int64))
        for step in range(1, height + width + 1):
            # Cells (i, step - i): i from `low` to `high`, without the edges of the table.
            low, high = max(1, step - width), min(height, step - 1)
            now = np.empty_like(last)
            if low <= high:
                differ = x[low - 1 : high] != y[width - step + low : width - step + high + 1]
                inner = np.minimum(last[low - 1 : high], last[low : high + 1]) + kind(1)
                now[low : high + 1] = np.minimum(inner, before[low - 1 : high] + differ)
            if step <= width:
                now[0] = step
            if step <= height:
                now[step] = step
            done = np.flatnonzero(m + n == step)
            found[done] = now[m[done], done]
            before, last = last, now
        return found

    return _in_slices(a, b, compare)


def _longest(x, y, part, alo, ahi, blo, bhi):
    """The longest common piece of each window, the earliest in the first text, then in the second: starts and length."""
    high, wide = int((ahi - alo).max()), int((bhi - blo).max())
    rows, columns = alo[None, :] + np.arange(high)[:, None], blo[None, :] + np.arange(wide)[:, None]
    one = x[np.minimum(rows, len(x) - 1), part]
    two = y[np.minimum(columns, len(y) - 1), part]
    # Two numbers that no character has, so that nothing beyond a window is equal.
    one[rows >= ahi[None, :]] = np.iinfo(x.dtype).max
    two[columns >= bhi[None, :]] = np.iinfo(x.dtype).max - 1
    lengths, new = np.zeros((wide + 1, len(part)), np.uint8), np.zeros((wide + 1, len(part)), np.uint8)
    longer, same = np.empty((wide, len(part)), np.uint8), np.empty((wide, len(part)), bool)
    best, i, j = np.zeros(len(part), np.uint8), np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    # A piece grows over many rows: its place in the second text is looked up once it has stopped.
    growing = np.zeros(len(part), bool)
    for row in range(high + 1):
        if row < high:
            np.add(lengths[:-1], np.uint8(1), out=longer)
            np.equal(two, one[row], out=same)
            np.multiply(longer, same, out=new[1:])
            most = new.max(axis=0)
            better = most > best
        else:
            better = np.zeros(len(part), bool)
        stopped = np.flatnonzero(growing & ~better)
        if len(stopped):
            j[stopped] = lengths[1:, stopped].argmax(axis=0)
        best, growing = np.where(better, most, best), better
        i[better] = row
        lengths, new = new, lengths
    best = best.astype(np.int64)
    return alo + i - best + 1, blo + j - best + 1, best


def _ends(x, y, m, n):
    """The windows left by a common beginning or end that is surely the longest common piece, and its length, else 0.

    A piece as long, at other places in both texts, would repeat the last characters of the beginning (the first of the
    end) a few places away, no further than the rest is long; where none of these places repeats them, there is no such piece.
    """
    part, zero = np.arange(len(m)), np.zeros_like(m)
    high, least, most = min(len(x), len(y)), np.minimum(m, n), np.maximum(m, n)
    places = np.arange(high)[:, None]
    begin = np.logical_and.accumulate((x[:high] == y[:high]) & (places < least), axis=0).sum(axis=0)
    same = x[np.maximum(m - 1 - places, 0), part] == y[np.maximum(n - 1 - places, 0), part]
    end = np.logical_and.accumulate(same & (places < least), axis=0).sum(axis=0)

    def sure(length, edge, step):
        rest = most - length
        found = np.flatnonzero(length >= rest + EDGE)
        edge, rest = edge[found], rest[found]
        repeated = np.zeros(len(found), bool)
        for shift in range(1, int(rest.max(initial=0)) + 1):
            equal = shift <= rest
            for k in range(EDGE):
                equal &= x[np.maximum(edge - step * k, 0), found] == x[np.clip(edge - step * (k + shift), 0, len(x) - 1), found]
            repeated |= equal
        return found[~repeated]

    windows, total = [part, zero.copy(), m.copy(), zero.copy(), n.copy()], np.zeros_like(m)
    at = sure(end, m - end, -1)
    windows[2][at], windows[4][at], total[at] = (m - end)[at], (n - end)[at], end[at]
    at = sure(begin, begin - 1, 1)
    windows[1][at] = windows[3][at] = total[at] = begin[at]
    windows[2][at], windows[4][at] = m[at], n[at]
    return tuple(windows), total


def _matched(left: list[str], right: list[str]) -> np.ndarray:
    (x, m), (y, n) = points(left, 0), points(right, 0)
    if max(x.max(), y.max()) < 254:
        x, y = x.astype(np.uint8), y.astype(np.uint8)
    windows, total = _ends(x, y, m, n)
    while True:
        some = (windows[1] < windows[2]) & (windows[3] < windows[4])
        windows = tuple(column[some] for column in windows)
        if not len(windows[0]):
            return total
        # Small windows do not wait for large ones.
        small = np.maximum(windows[2] - windows[1], windows[4] - windows[3]) <= SMALL
        after = []
        for group in (small, ~small):
            part, alo, ahi, blo, bhi = (column[group] for column in windows)
            if not len(part):
                continue
            i, j, size = _longest(x, y, part, alo, ahi, blo, bhi)
            np.add.at(total, part, size)
            hit = size > 0
            part, alo, ahi, blo, bhi, i, j, size = (column[hit] for column in (part, alo, ahi, blo, bhi, i, j, size))
            after += [(part, alo, i, blo, j), (part, i + size, ahi, j + size, bhi)]
        windows = tuple(np.concatenate(sides) for sides in zip(*after))


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """The matching-blocks ratio of each pair from 0 to 100: 100 for equal texts, 0 with an empty one."""
    scores = np.zeros(len(a), np.int64)
    short = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a, b)):
        if x == y:
            scores[k] = 100
        elif x and y and max(len(x), len(y)) < LONG:
            short[k] = True
        elif x and y:
            scores[k] = round(100 * SequenceMatcher(None, x, y).ratio())
    at = np.flatnonzero(short)
    if len(at):
        left, right = [a[k] for k in at], [b[k] for k in at]
        both = np.fromiter((len(x) + len(y) for x, y in zip(left, right)), np.int64, len(at))
        scores[at] = np.round(100 * (2.0 * _in_slices(left, right, _matched) / both)).astype(np.int64)
    return scores


def levenshtein_scores(a: list[str], b: list[str]) -> np.ndarray:
    """100 x (1 - distance / longer length), rounded half up, in whole numbers."""
    longer = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b)), np.int64, len(a))
    kept = longer - edit_distances(a, b)
    return np.where(longer == 0, 100, (kept * 200 + longer) // np.maximum(longer * 2, 1))


BATCH_SCORERS = {"levenshtein": levenshtein_scores, "ratio": ratios}
