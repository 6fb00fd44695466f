"""Benchmark passages in documents by the q-gram lemma and banded alignment.

A region that differs from an item of m bytes by at most e edits shares at least m - q + 1 - q*e of its q-grams, all on
e + 1 neighbouring diagonals. Shared q-grams are counted in overlapping bands of diagonals; regions that reach the
bound are aligned with the item inside their band. The same holds for each window of an item, so parts of long items are
found too. Items that are too short for edits are matched as they are, at the borders of words.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import IS_SPACE, LOWER, U64, fresh, record_batch, share, text_bytes, text_slices
from weftline.session import table_bytes

#: Benchmark texts that one pass over the documents looks for; more are done in further passes.
BLOCK_BYTES = 8 << 20

_Q = 8
_BITS = 22
_FACTOR = U64(0x9E3779B97F4A7C15)
_FAR = 1 << 20
_IN_WORD = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
#: Regions that are aligned at a time, and the most cells of their texts where bands are wide.
_TOGETHER = 64
_CELLS = 1 << 22
#: Shared q-grams that are held at a time.
_HITS = 1 << 20
#: Item and band or place in one number.
_LOW = 44


@dataclass(frozen=True)
class EditBudget:
    """Edits for each byte of an item or of a window of it; items of fewer bytes than `least` have none.

    Windows begin at every `step`-th byte, so that every part of an item of window + step - 1 bytes holds one. An item of
    more than `whole` bytes is looked for by its windows alone, which are then joined: work grows with its length only.
    """

    share: float = 0.1
    least: int = 40
    window: int = 96
    step: int = 8
    whole: int = 4096

    def edits(self, size: int) -> int:
        """The budget, as far as the lemma still asks for a shared q-gram."""
        return 0 if size < self.least else max(0, min(int(self.share * size), (size - _Q) // _Q))


def normalized(data: np.ndarray) -> np.ndarray:
    """Small letters for A-Z and a space for each white space byte; places stay as they are."""
    return np.where(IS_SPACE[data], np.uint8(0x20), LOWER[data])


def collapsed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalized texts with each run of white space as one space, the place that each byte had, and the new offsets."""
    space = IS_SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    kept = np.flatnonzero(keep)
    return normalized(data[kept]), kept, np.searchsorted(kept, offsets)


def _packed(data: np.ndarray, size: int) -> np.ndarray:
    """The `size` bytes (7 at most) from each place on as one number."""
    out = np.zeros(max(0, len(data) - size + 1), np.int64)
    for k in range(size):
        out = out << 8 | data[k : k + len(out)]
    return out


def gram_codes(data: np.ndarray) -> np.ndarray:
    """A code of the 8 bytes from each place on. Different grams may share a code, which only adds regions to align."""
    if len(data) < _Q:
        return np.empty(0, np.int64)
    two = data[:-1].astype(np.uint16) | data[1:].astype(np.uint16) << np.uint16(8)
    four = two[:-2].astype(np.uint32) | two[2:].astype(np.uint32) << np.uint32(16)
    eight = four[:-4].astype(U64) | four[4:].astype(U64) << U64(32)
    return (eight * _FACTOR >> U64(64 - _BITS)).astype(np.int64)


def align(items: list[np.ndarray], texts: list[np.ndarray], lows: np.ndarray, lanes: int, anchored: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Banded alignments, all at once: the least edits that turn each item into a part of its text, and the part's end.

    A band has `lanes` diagonals (text place minus item place) from its low one on. Anchored parts begin where the text does.
    """
    sizes, ends = np.array([len(i) for i in items]), np.array([len(t) for t in texts])
    order = np.argsort(-sizes, kind="stable")
    longest, lane = int(sizes.max()), np.arange(lanes)
    wanted = np.full((len(items), longest), -1, np.int16)
    window = np.full((len(items), longest + lanes), -2, np.int16)
    for r, k in enumerate(order.tolist()):
        wanted[r, : sizes[k]] = items[k]
        low = int(lows[k])
        part = texts[k][max(0, low) : max(0, low + longest + lanes)]
        window[r, max(0, -low) : max(0, -low) + len(part)] = part[: longest + lanes - max(0, -low)]
    sizes, ends, low = sizes[order], ends[order, None], lows[order, None]
    place = low + lane
    row = np.where((place < 0) | (place > ends), _FAR, place if anchored else 0).astype(np.int32)
    for i in range(longest):
        n = int(np.searchsorted(-sizes, -i, side="left"))  # items that are longer than i come first
        now, seen = row[:n], window[:n, i : i + lanes]
        new = now + (seen != wanted[:n, i, None]) + (seen < 0) * _FAR
        np.minimum(new[:, :-1], now[:, 1:] + 1, out=new[:, :-1])
        new = np.minimum.accumulate(new - lane, axis=1) + lane
        new[(place[:n] + i + 1 < 0) | (place[:n] + i + 1 > ends[:n])] = _FAR
        row[:n] = np.minimum(new, _FAR)
    best = np.argmin(row, axis=1)
    edits, stop = np.empty(len(items), np.int64), np.empty(len(items), np.int64)
    edits[order] = row[np.arange(len(items)), best]
    stop[order] = sizes + low[:, 0] + best
    return edits, stop


def _together(items: list, width) -> Iterator[list]:
    """Runs of items, so few that their number times the largest width stays bounded; one at least."""
    run, widest = [], 0
    for item in items:
        wide = max(widest, width(item))
        if run and (len(run) == _TOGETHER or (len(run) + 1) * wide > _CELLS):
            yield run
            run, wide = [], width(item)
        run.append(item)
        widest = wide
    if run:
        yield run


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    distinct, inverse = np.unique(np.concatenate([*keys, np.empty(0, np.int64)]), return_inverse=True)
    sums = np.bincount(inverse, np.concatenate([*counts, np.empty(0, np.int64)]), len(distinct))
    return distinct, sums.astype(np.int64)


def _within(spans: list[tuple[int, int]], place: int) -> bool:
    """Whether a place lies inside one of equally long spans, which are in order."""
    at = bisect.bisect_left(spans, (place, place))
    return at > 0 and spans[at - 1][1] > place


class _Tally:
    """Counts of keys over blocks; what is held is a few times the number of distinct keys."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held, self.limit = 0, 4 * _HITS

    def add(self, keys: np.ndarray) -> None:
        distinct, counts = np.unique(keys, return_counts=True)
        self.keys.append(distinct), self.counts.append(counts)
        self.held += len(distinct)
        if self.held > self.limit:
            distinct, counts = self.sums()
            self.limit = max(4 * _HITS, 2 * self.held)

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        distinct, counts = _summed(self.keys, self.counts)
        self.keys, self.counts, self.held = [distinct], [counts], len(distinct)
        return distinct, counts


class Searcher:
    """The q-grams of a bounded block of items, and the search for them."""

    def __init__(self, items: list[tuple[int, str]], budget: EditBudget):
        self.budget, self.ids, self.items, self.edits, self.need, self.window_need = budget, [], [], [], [], []
        #: Items of less than a q-gram: their numbers by length.
        self.tiny: dict[int, list[int]] = {}
        self.window_edits = budget.edits(budget.window)
        codes = []
        for item_id, text in items:
            given = np.frombuffer((text or "").encode("utf-8"), np.uint8)
            data = np.frombuffer(collapsed(given, np.array([0, len(given)]))[0].tobytes().strip(b" "), np.uint8)
            if not len(data):
                continue
            if len(data) < _Q:
                self.tiny.setdefault(len(data), []).append(len(self.ids))
            self.ids.append(item_id), self.items.append(data), self.edits.append(budget.edits(len(data)))
            codes.append(gram_codes(data))
        often = np.bincount(np.concatenate([*codes, np.empty(0, np.int64)]).astype(np.int64), minlength=1 << _BITS)
        entries = []
        of_window = budget.window - _Q + 1 - _Q * self.window_edits
        for k, own in enumerate(codes):
            need = len(own) - _Q * self.edits[k]
            parts = len(self.items[k]) > budget.window
            # Leaving out s of an item's grams lowers its bounds by s at most: the commonest are left out.
            out = max(0, min(need, of_window) if parts else need) // 2
            order = np.argsort(-often[own], kind="stable")
            kept = np.sort(order[out:])
            self.need.append(need - out)
            self.window_need.append(of_window - out if parts else _FAR)
            entries.append(np.stack([own[kept], np.full(len(kept), k), kept], axis=1))
        table = np.concatenate([*entries, np.empty((0, 3), np.int64)]).astype(np.int64)
        table = table[np.argsort(table[:, 0], kind="stable")]
        self.count = np.bincount(table[:, 0], minlength=1 << _BITS).astype(np.int32)
        self.first = (np.cumsum(self.count) - self.count).astype(np.int32)
        self.item, self.place = table[:, 1], table[:, 2]
        self.band = np.array([2 * (e + 1) for e in self.edits], np.int64)
        self.window_band = np.full(len(self.ids), 2 * (self.window_edits + 1), np.int64)
        self.need = [_FAR if len(i) > budget.whole else n for i, n in zip(self.items, self.need, strict=True)]
        self.bound, self.window_bound = np.array(self.need, np.int64), np.array(self.window_need, np.int64)
        # Diagonals are counted from where the longest item would begin before the text.
        self.shift = max((len(i) for i in self.items), default=0)

    def _hits(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, its place, diagonal) of all shared grams, in blocks of bounded size in the order of the text."""
        codes = gram_codes(data)
        found = np.flatnonzero(self.count[codes])
        if not len(self.ids):
            return
        hit = codes[found]
        ends, at = np.cumsum(self.count[hit], dtype=np.int64), 0
        while at < len(found):
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + _HITS, side="right")))
            many = self.count[hit[at:stop]]
            own = ends[at:stop] - before
            entry = np.arange(own[-1]) + np.repeat(self.first[hit[at:stop]] - (own - many), many)
            place = self.place[entry]
            yield self.item[entry], place, np.repeat(found[at:stop], many) - place + self.shift
            at = stop

    @staticmethod
    def _bands(item: np.ndarray, diagonal: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Both bands of each hit, as (item, first diagonal in halves of a band)."""
        width = band[item]
        bands = [2 * ((diagonal + half * (width // 2)) // width) - half + 1 for half in (0, 1)]
        return np.concatenate([item << _LOW | b for b in bands])

    def _regions(self, tally: _Tally, band: np.ndarray, bound: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal, one past the last) of all bands that reach the bound."""
        keys, counts = tally.sums()
        # Bands that overlap are one region: two parts that match an item lie further apart than a band is wide.
        merged: list[list[int]] = []
        for key in keys[counts >= bound[keys >> _LOW]].tolist():
            k, w = key >> _LOW, int(band[key >> _LOW])
            first = ((key & ((1 << _LOW) - 1)) - 1) * (w // 2) - self.shift
            if merged and merged[-1][0] == k and first <= merged[-1][1] + w:
                merged[-1][2] = first + w
            else:
                merged.append([k, first, first + w])
        return [tuple(r) for r in merged]

    def _windows(self, low: np.ndarray, regions: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
        """(region, start of a window of its item) of all windows that share enough grams within the region.

        Regions are in order and no diagonal of an item lies in more than two, so each hit finds its own by bisection.
        """
        items, firsts, lasts = (np.array(c, np.int64) for c in zip(*regions, strict=True))
        pad, long = int(self.window_band.max()), max(len(i) for i in self.items)
        heads = items << _LOW | (firsts + self.shift + pad)
        wanted = np.zeros(len(self.items), bool)
        wanted[items] = True
        tally = _Tally()
        for item, place, diagonal in self._hits(low):
            chosen = wanted[item]
            item, place, diagonal = item[chosen], place[chosen], diagonal[chosen]
            last = np.searchsorted(heads, item << _LOW | (diagonal + pad), side="right") - 1
            for r in (last, last - 1):
                own = np.maximum(r, 0)
                inside = (r >= 0) & (items[own] == item) & (diagonal - self.shift < lasts[own])
                tally.add(r[inside] * long + place[inside])
        codes, counts = tally.sums()
        before = np.concatenate([[0], np.cumsum(counts)])
        size, step = self.budget.window, self.budget.step
        for r, k in enumerate(items.tolist()):
            begins = np.unique(np.append(np.arange(0, len(self.items[k]) - size, step), len(self.items[k]) - size))
            stop = np.searchsorted(codes, r * long + begins + size - _Q, side="right")
            inside = before[stop] - before[np.searchsorted(codes, r * long + begins)]
            for begin in begins[inside >= self.window_bound[k]].tolist():
                yield r, begin

    @staticmethod
    def _texts(low: np.ndarray, offsets: np.ndarray, begin: int, stop: int, least: int) -> Iterator[tuple[int, int, int]]:
        """(text, start and end of its part) of each text that has so many bytes of a region at least."""
        begin, stop = max(0, begin), min(len(low), stop)
        for t in range(int(np.searchsorted(offsets, begin, side="right")) - 1, int(np.searchsorted(offsets, stop, side="left"))):
            a, b = max(begin, int(offsets[t])), min(stop, int(offsets[t + 1]))
            if b - a >= least:
                yield t, a, b

    def _candidates(self, low: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int, int]]:
        """(item, start and end of its part, text, start and end of the region, first diagonal, lanes) of whole items and windows."""
        whole, parts = _Tally(), _Tally()
        for item, _, diagonal in self._hits(low):
            whole.add(self._bands(item, diagonal, self.band))
            parts.add(self._bands(item, diagonal, self.window_band))
        for k, first, last in self._regions(whole, self.band, self.bound):
            size, edits = len(self.items[k]), self.edits[k]
            for t, a, b in self._texts(low, offsets, first - edits, last + size + edits, size - edits):
                yield k, 0, size, t, a, b, first - edits, last - first + 2 * edits + 1
        regions = self._regions(parts, self.window_band, self.window_bound)
        if not regions:
            return
        size, edits = self.budget.window, self.window_edits
        for r, begin in self._windows(low, regions):
            k, first, last = regions[r]
            for t, a, b in self._texts(low, offsets, first + begin - edits, last + begin + size + edits, size - edits):
                yield k, begin, begin + size, t, a, b, first + begin - edits, last - first + 2 * edits + 1

    def _aligned(self, low: np.ndarray, candidates: list) -> Iterator[tuple[tuple, int, int]]:
        """(candidate, least edits, end of the match) of all candidates."""
        for some in _together(candidates, lambda c: c[2] - c[1] + c[7]):
            first = np.array([c[6] - c[4] for c in some])
            parts = [self.items[c[0]][c[1] : c[2]] for c in some]
            edits, ends = align(parts, [low[c[4] : c[5]] for c in some], first, max(c[7] for c in some))
            for c, e, z in zip(some, edits.tolist(), ends.tolist(), strict=True):
                yield c, e, c[4] + z

    def _spans(self, low: np.ndarray, matches: list) -> Iterator[tuple[tuple, int, int, int]]:
        """(candidate, edits, start, end) of all matches: their starts by alignment from their ends."""
        for good in _together(matches, lambda m: m[0][2] - m[0][1] + 2 * m[1]):
            most = max(max(e for _, e, _ in good), 1)
            items = [self.items[c[0]][c[1] : c[2]][::-1] for c, _, _ in good]
            _, lengths = align(items, [low[c[4] : z][::-1] for c, _, z in good], np.full(len(good), -most), 2 * most + 1, anchored=True)
            for (c, e, z), length in zip(good, lengths.tolist(), strict=True):
                yield c, e, max(c[4], z - length), z

    def _joined(self, low: np.ndarray, offsets: np.ndarray, matches: list) -> list:
        """Matching windows that overlap in item and text as one part of the item, aligned anew."""
        parts: list[list[int]] = []
        for c, _, start, end in sorted(matches, key=lambda m: (m[0][0], m[0][3], m[2] - m[0][1], m[0][1])):
            last = parts[-1] if parts else None
            near = last and last[0] == c[0] and last[3] == c[3] and abs((start - c[1]) - (last[4] - last[1])) <= 2 * int(self.window_band[c[0]])
            if near and c[1] <= last[2] and c[2] >= last[1]:
                last[1], last[2], last[4], last[5] = min(last[1], c[1]), max(last[2], c[2]), min(last[4], start), max(last[5], end)
            else:
                parts.append([c[0], c[1], c[2], c[3], start, end])
        spread = 4 * (self.window_edits + 1)
        again = []
        for k, x, y, t, start, end in parts:
            a, b = max(int(offsets[t]), start - spread), min(int(offsets[t + 1]), end + spread)
            again.append((k, x, y, t, a, b, start - spread, 2 * spread + abs(end - start - (y - x)) + spread))
        return [(c, e, z) for c, e, z in self._aligned(low, again) if e < c[2] - c[1]]

    def _short(self, low: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of all places of items that are shorter than a gram."""
        for size, numbers in self.tiny.items():
            codes = _packed(low, size)
            for k in numbers:
                for start in np.flatnonzero(codes == _packed(self.items[k], size)[0]).tolist():
                    if start + size <= offsets[np.searchsorted(offsets, start, side="right")]:
                        yield k, start, start + size

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of all matches; places are bytes of the text.

        Of overlapping ones a whole item stays before parts of it, and then the best.
        """
        low, kept, bounds = collapsed(data, offsets)
        candidates = list(self._candidates(low, bounds))
        full = [c for c in candidates if c[2] - c[1] == len(self.items[c[0]])]
        whole = [(c, e, z) for c, e, z in self._aligned(low, full) if e <= self.edits[c[0]]]
        # Windows where the whole item is need no look: it stays before its parts.
        places: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for c, _, z in whole:
            places.setdefault((c[0], c[3]), []).append((z - len(self.items[c[0]]), z))
        windows = [c for c in candidates if c[2] - c[1] < len(self.items[c[0]])]
        for spans in places.values():
            spans.sort()
        windows = [c for c in windows if not _within(places.get((c[0], c[3]), []), (c[4] + c[5]) // 2)]
        windows = [(c, e, z) for c, e, z in self._aligned(low, windows) if e <= self.window_edits]
        # (text, item) -> (part, edits, start, end)
        found: dict[tuple[int, int], list[tuple[bool, int, int, int]]] = {}
        parts = self._joined(low, bounds, list(self._spans(low, windows)))
        for c, e, start, end in self._spans(low, [*whole, *parts]):
            part = c[2] - c[1] < len(self.items[c[0]])
            if len(self.items[c[0]]) >= self.budget.least or self._at_words(low, bounds, start, end):
                found.setdefault((c[3], c[0]), []).append((part, e, start, end))
        for k, start, end in self._short(low, bounds):
            if self._at_words(low, bounds, start, end):
                found.setdefault((int(np.searchsorted(bounds, start, side="right")) - 1, k), []).append((False, 0, start, end))
        out = []
        for (t, k), spans in sorted(found.items()):
            taken: list[tuple[int, int]] = []
            for _, distance, start, end in sorted(spans):
                at = bisect.bisect(taken, (start, end))
                if (not at or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
                    taken.insert(at, (start, end))
                    out.append((t, self.ids[k], int(kept[start] - offsets[t]), int(kept[end - 1] + 1 - offsets[t]), distance))
        return out

    @staticmethod
    def _at_words(low: np.ndarray, offsets: np.ndarray, start: int, end: int) -> bool:
        """Whether a place neither begins nor ends within a word of its text."""
        t = int(np.searchsorted(offsets, start, side="right")) - 1
        for inner, outer, inside in ((start, start - 1, start > offsets[t]), (end - 1, end, end < offsets[t + 1])):
            if inside and _IN_WORD[low[inner]] and _IN_WORD[low[outer]]:
                return False
        return True


def _blocks(benchmark: DataFrame, budget: EditBudget) -> Iterator[Searcher]:
    """Searchers for all items, each of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    count = max(1, -(-table_bytes(items) // BLOCK_BYTES))
    for block in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        yield Searcher(sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r)), budget)


def find_passages(documents: DataFrame, benchmark: DataFrame, budget: EditBudget = EditBudget()) -> DataFrame:
    """doc_id, item_id, start, end, edits of every passage that is in a document, in places of code points; one narrow pass.

    `documents` has doc_id and text, `benchmark` item_id and text; other columns are not read. A null or empty text has no
    passage; null and blank items are never found; null keys stay null; items with the same text are each found; repeated
    rows repeat. Passages are found in whole texts: whole items, and parts of an item that hold a window within its budget.
    Items of more than 4,096 bytes are put together from their windows. Work on a text grows with the q-grams that it shares
    with items, also where one line or character is repeated all over it.
    Of overlapping matches with one item a whole one, then the one with the fewest edits is returned. Empty tables give no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])
    kind, out = "doc_id long, item_id long, start long, end long, edits long", None
    for searcher in _blocks(benchmark, budget):
        given = share(documents.sparkSession, searcher)

        def task(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, "text"):
                data, offsets = text_bytes(batch.column(1))
                found = given.value.search(data, offsets)
                if found:
                    first = (data & 0xC0) != 0x80  # bytes that begin a code point
                    rows, items, starts, ends, edits = (list(c) for c in zip(*found, strict=True))
                    count = [[int(first[offsets[t] : offsets[t] + p].sum()) for t, p in zip(rows, places, strict=True)] for places in (starts, ends)]
                    yield record_batch(schema, batch.column(0).take(pa.array(rows)), items, *count, edits)

        part = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, kind)
        out = part if out is None else out.unionByName(part)
    return out


def _contaminated(given):
    @F.arrow_udf("boolean")
    def contaminated(texts: pa.Array) -> pa.Array:
        batch, out = pa.RecordBatch.from_arrays([texts], ["text"]), []
        for part in text_slices(iter([batch]), "text"):
            flags = np.zeros(part.num_rows, dtype=bool)
            flags[[row[0] for row in given.value.search(*text_bytes(part.column(0)))]] = True
            out.append(flags)
        return pa.array(np.concatenate([*out, np.empty(0, bool)]))

    return contaminated


def keep_clean(documents: DataFrame, benchmark: DataFrame, budget: EditBudget = EditBudget()) -> DataFrame:
    """The rows, with all their columns, that hold no passage of the benchmark; a null text is kept."""
    name = fresh(documents, "contaminated")
    for searcher in _blocks(benchmark, budget):
        contaminated = _contaminated(share(documents.sparkSession, searcher))
        documents = documents.withColumn(name, contaminated(F.col("text"))).filter(~F.col(name)).drop(name)
    return documents
