"""Benchmark passages in documents: q-gram lemma filter in diagonal bands, then banded alignment.

Texts are folded (lower case, runs of anything but letters and digits to one blank). Each benchmark item is searched as
windows of WINDOW folded characters, one every STRIDE, so any stretch of WINDOW + STRIDE - 1 characters holds a whole one.
A window of n characters with at most k edits shares n - q + 1 - k q of its q-grams or more with its copy, all within
k + 1 neighbouring diagonals. Diagonals are counted in bands of STEP + k that begin every STEP, so some band holds them
all. The places of an item whose q-grams are shared are listed once a band, and windows with enough of them are aligned
within the band. Equal q-grams in a row (runs of one character) enter a band as one.

The benchmark is read in blocks of bounded size, each searched in all documents; the leaks of a block are stored when
the next one is read.

Edge cases: null and empty texts hold no passage. Items under SHORTEST folded characters leave no room for edits: they are
found where they stand as whole words, but a document is not dropped for them, as such strings stand in clean texts too.
Items without letters and digits are not searched. Equal items are all reported. Repeated documents are searched one by
one. Empty tables give no rows. Other columns stay as they are and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwarden.session import cut_lineage, discard

Q = 10
WINDOW = 80
STRIDE = 16
EDIT_RATE = 0.075
SHORTEST = 24
STEP = 16
#: Characters of benchmark text whose index a task holds at once, and of documents searched at once. Neither changes rows.
BLOCK_CHARS = 1_000_000
BATCH_CHARS = 4_000_000
#: Runs of equal q-grams are cut to RUN places; about so many places of items are put into bands at once.
RUN = 4 * STEP
SLICE = 1_000_000

BLANK, GAP = 32, 0x110000
LEAK = pa.struct([("item_id", pa.int64()), ("windows", pa.int64()), ("edits", pa.int64()), ("first_char", pa.int64()), ("end_char", pa.int64())])
LEAKS = "array<struct<item_id: bigint, windows: bigint, edits: bigint, first_char: bigint, end_char: bigint>>"


@lru_cache(1)
def _folds() -> np.ndarray:
    """For each character of the basic plane its folded form; those beyond fold to themselves."""
    folded = (chr(c).lower() if chr(c).isalnum() else " " for c in range(0x10000))
    return np.array([ord(f) if len(f) == 1 else c for c, f in enumerate(folded)], np.uint32)


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The folded characters and the place in `text` of each."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    folded = np.where(raw < 0x10000, _folds()[np.minimum(raw, 0xFFFF)], raw)
    kept = np.ones(len(folded), bool)
    kept[1:] = (folded[1:] != BLANK) | (folded[:-1] != BLANK)
    return folded[kept], np.flatnonzero(kept)


def stripped(text: str) -> np.ndarray:
    """The folded characters without blanks at the ends."""
    chars = fold(text)[0]
    return chars[int(chars[:1].tolist() == [BLANK]) : len(chars) - int(chars[-1:].tolist() == [BLANK])]


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of each q-gram, by doubling the length hashed."""
    if len(chars) < q:
        return np.empty(0, np.uint64)
    base, size, done, hashed, power = 0x9E3779B97F4A7C15, 1, 0, None, 1
    part, part_power, rest = chars.astype(np.uint64), base, q
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if hashed is None:
                    hashed, done, power = part, size, part_power
                else:
                    n = min(len(hashed), len(part) - done)
                    hashed = hashed[:n] + np.uint64(power) * part[done : done + n]
                    done, power = done + size, power * part_power % 2**64
            rest >>= 1
            if rest:
                part = part[: len(part) - size] + np.uint64(part_power) * part[size:]
                size, part_power = 2 * size, part_power * part_power % 2**64
    return hashed * np.uint64(0xD6E8FEB86659FD93)


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each range, one range after the other."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


class ShortItems:
    """Items too short for edits, found as whole words by a hash of their own length."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.lengths: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        for n in sorted({len(chars) for _, chars in items}):
            same = [(item, chars) for item, chars in items if len(chars) == n]
            hashes = np.array([grams(chars, n)[0] for _, chars in same], np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.lengths[n] = hashes[order], np.stack([same[i][1] for i in order]), [same[i][0] for i in order]

    def find(self, chars: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of each place."""
        outside = np.concatenate([[True], (chars == BLANK) | (chars == GAP), [True]])
        for n, (hashes, wanted, items) in self.lengths.items():
            places = np.flatnonzero(outside[: max(0, len(chars) - n + 1)] & outside[n + 1 :])
            hashed = grams(chars, n)[places]
            low, high = np.searchsorted(hashes, hashed, "left"), np.searchsorted(hashes, hashed, "right")
            at, places = spread(low, high - low), np.repeat(places, high - low)
            for entry, place in zip(at.tolist(), places.tolist(), strict=True):
                if np.array_equal(wanted[entry], chars[place : place + n]):
                    yield items[entry], place, place + n


class Passages:
    """The q-gram index of some benchmark items: `bench` is their folded text, a window a stretch of it."""

    def __init__(self, items: list[tuple[int, str]]):
        short: list[tuple[int, np.ndarray]] = []
        self.items: list[int] = []
        starts, sizes, texts, places, hashes, at = [], [], [], [], [], 0
        # Items are so far apart that no window's worth of places holds two.
        apart = np.full(WINDOW, GAP + 1, np.uint32)
        for item, text in items:
            chars = stripped(text)
            if 0 < len(chars) < SHORTEST:
                short.append((item, chars))
            if len(chars) < SHORTEST:
                continue
            last = max(0, len(chars) - WINDOW)
            for start in sorted({*range(0, last, STRIDE), last}):
                self.items.append(item)
                starts.append(at + start)
                sizes.append(min(len(chars), WINDOW))
            hashes.append(grams(chars))
            places.append(at + np.arange(len(hashes[-1])))
            texts += [chars, apart]
            at += len(chars) + WINDOW
        self.short = ShortItems(short)
        self.bench = np.concatenate([*texts, apart])
        self.start, self.size = np.array(starts, np.int64), np.array(sizes, np.int64)
        # Never so many edits that no q-gram need be left.
        self.edits = np.minimum((self.size * EDIT_RATE).astype(np.int64), (self.size - Q) // Q)
        self.least = self.size - Q + 1 - self.edits * Q
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.place = np.concatenate(places)[order] if places else np.empty(0, np.int64)
        self.bits = max(16, int(len(flat)).bit_length() + 4)
        self.known = np.zeros(1 << self.bits, bool)
        self.known[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def runs(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place, places, number of the q-gram) of the runs of one q-gram that an item has, cut to RUN places."""
        hashed = grams(chars)
        begin = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1]])[: len(hashed)])
        size = np.diff(np.append(begin, len(hashed)))
        hashed = hashed[begin]
        near = np.flatnonzero(self.known[(hashed >> np.uint64(64 - self.bits)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashed[near]), len(self.hashes) - 1)
        same = self.hashes[at] == hashed[near]
        begin, size, at = begin[near[same]], size[near[same]], at[same]
        cuts = -(-size // RUN)
        piece = spread(np.zeros_like(cuts), cuts) * RUN
        return np.repeat(begin, cuts) + piece, np.minimum(np.repeat(size, cuts) - piece, RUN), np.repeat(at, cuts)

    def window_at(self, place: np.ndarray) -> np.ndarray:
        """A window of the item that holds a place of `bench`: the last to start there or before, all of an item being alike."""
        return np.searchsorted(self.start, place, "right") - 1

    def bands(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place in the text that its start has on the band's first diagonal) where the bound of the lemma is met.

        A stretch of the text at a time, each with as much of the next as a match can take.
        """
        begin, size, gram = self.runs(chars)
        stretch = np.cumsum(self.count[gram] * (size // STEP + 2)) // SLICE
        cuts = np.append(np.flatnonzero(np.diff(stretch, prepend=-1)), len(begin))
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if high < len(begin):
                high = int(np.searchsorted(begin, begin[high] + WINDOW + int(self.edits.max()), "right"))
            yield self._bands(begin[low:high], size[low:high], gram[low:high])

    def _bands(self, begin: np.ndarray, size: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = self.count[gram]
        place = self.place[spread(self.first[gram], count)]
        begin, size = np.repeat(begin, count), np.repeat(size, count)
        wide = STEP + self.edits[self.window_at(place)]
        band = -((wide - 1 - begin + place) // STEP)
        bands = (begin - place + size - 1) // STEP - band + 1
        lowest = len(self.bench) // STEP + WINDOW
        unit = len(self.bench) + WINDOW
        keys = np.unique((spread(band, bands) + lowest) * unit + np.repeat(place, bands))
        # Enough places from here on within a window's length: all windows that hold them, each listed once.
        window = self.window_at(keys % unit)
        span, until = self.size[window] - Q, np.arange(len(keys)) + self.least[window] - 1
        reached = np.flatnonzero(until < len(keys))
        reached = reached[keys[until[reached]] - keys[reached] <= span[reached]]
        band = keys[reached] // unit
        first = np.searchsorted(self.start, keys[until[reached]] % unit - span[reached], "left")
        end = np.searchsorted(self.start, keys[reached] % unit, "right")
        first[1:] = np.where(band[1:] == band[:-1], np.maximum(first[1:], end[:-1]), first[1:])
        count = np.maximum(end - first, 0)
        window, band = spread(first, count), np.repeat(band, count) - lowest
        return window, band * STEP + self.start[window]

    def align(self, chars: np.ndarray, window: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The fewest edits of each window against the text on its band's diagonals, and where that match starts and ends."""
        wide = STEP + int(self.edits.max(initial=0))
        text = np.concatenate([np.full(wide, GAP, np.uint32), chars, np.full(WINDOW + wide, GAP, np.uint32)])
        # A cell holds edits * 256 + the diagonal that the match began on; the smaller diagonal wins ties.
        unit, diagonals = 256, np.arange(wide)
        outside = diagonals[None, :] >= (STEP + self.edits[window])[:, None]
        cell = np.where(outside, unit * unit, np.tile(diagonals, (len(window), 1)))
        result = np.full((len(window), wide), unit * unit)
        for row in range(WINDOW):
            piece = text[np.clip(first[:, None] + wide + row + diagonals, 0, len(text) - 1)]
            across = cell + unit * (piece != self.bench[self.start[window] + row][:, None])
            down = np.concatenate([cell[:, 1:], np.full((len(cell), 1), unit * unit)], 1) + unit
            best = np.minimum(across, down)
            cell = np.minimum.accumulate(best - unit * diagonals, 1) + unit * diagonals
            cell[outside] = unit * unit
            done = self.size[window] == row + 1
            result[done] = cell[done]
        end = result.argmin(1)
        best = result[np.arange(len(result)), end]
        return best // unit, first + best % unit, first + end + self.size[window]

    def search(self, texts: list[str]) -> list[list[dict]]:
        """For each text its leaks: per item the windows found, the fewest edits, and the stretch of the text they cover."""
        found: list[dict[int, dict]] = [{} for _ in texts]
        folded = [fold(t) for t in texts]
        # More blanks than edits between two texts: no match spans them.
        gap = np.full(int(self.edits.max(initial=0)) + 1, GAP, np.uint32)
        sizes = np.array([len(chars) + len(gap) for chars, _ in folded], np.int64)
        starts = np.cumsum(sizes) - sizes
        chars = np.concatenate([part for chars, _ in folded for part in (chars, gap)] or [gap])

        def note(item: int, window: int | None, edits: int, start: int, end: int) -> None:
            # Edits at either end may lie between two texts, the middle never does.
            doc = int(np.searchsorted(starts, (start + end) // 2, "right")) - 1
            places = folded[doc][1]
            a = min(max(0, start - int(starts[doc])), len(places) - 1)
            b = min(max(0, end - int(starts[doc]) - 1), len(places) - 1)
            self._note(found[doc], item, window, edits, int(places[a]), int(places[b]) + 1)

        for item, start, end in self.short.find(chars):
            note(item, None, 0, start, end)
        if self.items:
            for window, first in self.bands(chars):
                for low in range(0, len(window), 4096):
                    part = window[low : low + 4096]
                    edits, start, end = self.align(chars, part, first[low : low + 4096])
                    for n in np.flatnonzero(edits <= self.edits[part]).tolist():
                        note(self.items[int(part[n])], int(part[n]), int(edits[n]), int(start[n]), int(end[n]))
        return [[{"item_id": item, "windows": len(x.pop("of")), **x} for item, x in sorted(leaks.items(), key=lambda leak: (leak[0] is None, leak[0]))] for leaks in found]

    @staticmethod
    def _note(leaks: dict, item: int, window: int | None, edits: int, first: int, end: int) -> None:
        leak = leaks.setdefault(item, {"of": set(), "edits": edits, "first_char": first, "end_char": end})
        leak["of"].add(window)
        leak.update(edits=min(leak["edits"], edits), first_char=min(leak["first_char"], first), end_char=max(leak["end_char"], end))


def leaks_column(text: Column, items: list[tuple[int, str]]) -> Column:
    """The leaks of a block of benchmark items in a text, as an array; none for a null text."""

    @F.arrow_udf(LEAKS)
    def leaks(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        passages = Passages(items)
        for part in parts:
            rows, batch, size = [], [], 0
            for value in part:
                batch.append(value.as_py() or "")
                size += len(batch[-1])
                if size >= BATCH_CHARS:
                    rows += passages.search(batch)
                    batch, size = [], 0
            yield pa.array(rows + (passages.search(batch) if batch else []), pa.list_(LEAK))

    return leaks(text)


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", most: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark as lists of (item, text) of at most about `most` characters, one in memory at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item).cast("long"), F.col(text)).where(F.col(text).isNotNull()).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and benchmark item that it holds: key, item_id, windows found, fewest edits, first_char, end_char."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    result, stored = rows.select("_key", F.inline(F.lit(None).cast(LEAKS))), []
    for number, items in enumerate(blocks(benchmark)):
        # The leaks of one block stay a plan; of several, each is stored when the next block is read.
        if number:
            stored.append(cut_lineage(result))
        result = rows.select("_key", F.inline(leaks_column(F.col("_text"), items)))
    for part in stored:
        result = result.unionByName(part)
    return result.withColumnRenamed("_key", key)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """The documents that hold no benchmark passage, with the columns they came with. Items under `shortest` folded characters drop none."""
    last = None
    for number, items in enumerate(blocks(benchmark)):
        # One block's index in a task at a time.
        kept = cut_lineage(docs) if number else docs
        if last is not None:
            discard(last)
        last = kept if number else None
        long = [(item, words) for item, words in items if len(stripped(words)) >= shortest]
        docs = kept.where(F.size(leaks_column(F.col(text), long)) == 0)
    return docs
