"""Periodic runs of words: a run-length grammar by recompression, and extensions of a harmonic grid of candidates.

The words of a slice of documents become numbers, with a mark of its own after each document. Block compression turns each
stretch of one symbol into a symbol; pair compression turns each neighbouring pair of a left and a right symbol into one.
Both alternate until little is left. Whether a symbol begins at a place depends on the two symbols beside it only,
so equal stretches are parsed alike and two places are compared by climbing and descending the levels, a few
symbols on each (LCE). A run of period q and length 2q or more holds two neighbouring multiples of q, so pairs of
places (i, i + q) with i a multiple of q are all candidates: n ln n of them. Those whose words differ go, the rest is
extended exactly to both sides.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftline.llm.common import U64, mix, share, text_bytes, text_slices

#: Shortest run, in words.
SHORTEST = 12
#: Candidates that are looked at together.
_CANDIDATES = 1 << 20
#: Levels end where a sequence is this short, or doesn't get shorter.
_TOP = 16


@dataclass(frozen=True)
class _Level:
    """A sequence of symbols; ends in one that is nowhere else.

    width: words below each symbol. begins: whether a symbol of the next level begins here, up: that symbol. down: the place of the
    first symbol below, on the level before. left: equal symbols from here on, within a block.
    """

    symbols: np.ndarray
    width: np.ndarray
    begins: np.ndarray
    up: np.ndarray
    down: np.ndarray
    left: np.ndarray


def _stretches(symbols: np.ndarray) -> np.ndarray:
    """Whether a stretch of one symbol begins at each place."""
    begins = np.ones(len(symbols), bool)
    begins[1:] = symbols[1:] != symbols[:-1]
    return begins


def _pairs(symbols: np.ndarray, turn: int) -> np.ndarray:
    """Whether a symbol of the next level begins at each place: all but the right halves of pairs."""
    side = (mix(symbols.astype(U64) + U64(turn << 40)) & U64(1)).astype(bool)
    second = np.zeros(len(symbols), bool)
    one, other = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
    second[1:] = one if one.sum() >= other.sum() else other
    return ~second


class Grammar:
    """The levels of a sequence of numbers, and longest common extensions to the right or, of the mirror image, to the left."""

    def __init__(self, words: np.ndarray):
        # The last symbol stands for the end of the sequence on every level.
        symbols = np.append(words, words.max(initial=-1) + 1).astype(np.int64)
        width = np.ones(len(symbols), np.int64)
        width[-1] = 0
        self.steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # symbols, width, begins
        turn = 0
        while len(symbols) > _TOP:
            begins = _stretches(symbols)
            if begins.all():  # no blocks: pairs at once
                turn += 1
                begins = _pairs(symbols, turn)
                begins[-1] = True
                if begins.all():
                    if turn > 64:
                        break
                    continue
            self.steps.append((symbols, width, begins))
            first = np.flatnonzero(begins)
            size = np.diff(np.append(first, len(symbols)))
            # A symbol of the next level is named by its first and last symbol and their number.
            last = symbols[first + size - 1]
            names = (symbols[first] * (int(symbols.max()) + 1) + last).astype(np.int64)
            _, names = np.unique(names, return_inverse=True)
            _, names = np.unique(names * (int(size.max()) + 1) + size, return_inverse=True)
            width = np.add.reduceat(width, first)
            symbols = names.astype(np.int64)
        self.steps.append((symbols, width, np.ones(len(symbols), bool)))
        self.forward = self._levels(False)
        self.backward = self._levels(True)

    def _levels(self, mirrored: bool) -> list[_Level]:
        out: list[_Level] = []
        down = np.arange(len(self.steps[0][0]))
        for symbols, width, begins in self.steps:
            if mirrored:  # the end mark goes to the end again
                symbols, width = (np.append(x[-2::-1], x[-1]) for x in (symbols, width))
                ends = np.append(begins[1:], True)
                begins = np.append(ends[-2::-1], True)
            starts = np.flatnonzero(_stretches(symbols))
            after = np.append(starts[1:], len(symbols))
            left = np.repeat(after, after - starts) - np.arange(len(symbols))
            out.append(_Level(symbols, width, begins, np.cumsum(begins) - 1, down, left))
            down = np.flatnonzero(begins)
        return out

    def extension(self, one: np.ndarray, other: np.ndarray, mirrored: bool = False) -> np.ndarray:
        """The number of equal words from the places `one` and `other` on, which differ; mirrored: places from the end."""
        levels = self.backward if mirrored else self.forward
        x, y = one.copy(), other.copy()
        found = np.zeros(len(x), np.int64)
        stopped = np.zeros(len(x), np.int64)
        alive = np.arange(len(x))
        for t, level in enumerate(levels):
            top = t + 1 == len(levels)
            here, kept = alive, []
            while len(here):
                if not top:
                    climb = level.begins[x[here]] & level.begins[y[here]]
                    kept.append(here[climb])
                    here = here[~climb]
                equal = level.symbols[x[here]] == level.symbols[y[here]]
                stopped[here[~equal]] = t
                here = here[equal]
                self._advance(level, here, x, y, found)
            if top or not (alive := np.concatenate(kept)).size:
                break
            x[alive], y[alive] = level.up[x[alive]], level.up[y[alive]]
        # Down again: the symbols at x and y differ; find how much of them is equal.
        for t in range(int(stopped.max(initial=0)), 0, -1):
            here = np.flatnonzero(stopped == t)
            down, below = levels[t].down, levels[t - 1]
            x[here], y[here] = down[x[here]], down[y[here]]
            stopped[here] = t - 1
            while len(here):
                here = here[below.symbols[x[here]] == below.symbols[y[here]]]
                self._advance(below, here, x, y, found)
        return found

    @staticmethod
    def _advance(level: _Level, here: np.ndarray, x: np.ndarray, y: np.ndarray, found: np.ndarray) -> None:
        """Step over equal symbols, a whole stretch of them at once."""
        count = np.minimum(level.left[x[here]], level.left[y[here]])
        found[here] += count * level.width[x[here]]
        x[here] += count
        y[here] += count


def find_runs(words: np.ndarray, first: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """document, start, length, period of all runs (a row each, sorted) of documents that begin at `first` (and the end)."""
    sizes = np.diff(first)
    due = np.flatnonzero(sizes >= shortest)
    none = np.empty((0, 4), np.int64)
    if not len(due):
        return none
    # The sequence of the due documents, each with a mark of its own at its end.
    lengths = sizes[due]
    begin = np.cumsum(lengths + 1) - lengths - 1
    sequence = np.empty(int((lengths + 1).sum()), np.int64)
    marks = begin + lengths
    inside = np.ones(len(sequence), bool)
    inside[marks] = False
    sequence[inside] = words[np.repeat(first[due] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
    sequence[marks] = int(words.max()) + 1 + np.arange(len(due))
    total = len(sequence)
    halves = lengths // 2
    ends = np.cumsum(halves)
    grammar, found = None, []
    low_document, low_period = 0, 1
    while low_document < len(due):
        # A block of (document, period) with about _CANDIDATES places: whole documents, or some periods of a large one.
        document, period, places = [], [], 0
        while low_document < len(due) and places < _CANDIDATES:
            n, half = int(lengths[low_document]), int(halves[low_document])
            q = np.arange(low_period, half + 1)
            counts = np.cumsum((n - 1) // q)
            take = max(1, int(np.searchsorted(counts, _CANDIDATES - places, side="right")))
            q = q[:take]
            document.append(np.full(len(q), low_document)), period.append(q)
            places += int(counts[len(q) - 1])
            low_document, low_period = (low_document + 1, 1) if int(q[-1]) == half else (low_document, int(q[-1]) + 1)
        d, q = np.concatenate(document), np.concatenate(period)
        counts = (lengths[d] - 1) // q
        before = np.cumsum(counts) - counts
        step = np.arange(counts.sum()) - np.repeat(before, counts)
        q, base = np.repeat(q, counts), np.repeat(begin[d], counts)
        i = base + step * q
        equal = np.flatnonzero(sequence[i] == sequence[i + q])
        if not len(equal):
            continue
        if grammar is None:
            grammar = Grammar(sequence)
        i, q, base = i[equal], q[equal], base[equal]
        d = np.searchsorted(begin, i, side="right") - 1
        right = grammar.extension(i, i + q)
        back = grammar.extension(total - i, total - i - q, mirrored=True)
        length = back + q + right
        start = i - back
        # A mark is nowhere else, so nothing reaches over one.
        good = length >= np.maximum(shortest, 2 * q)
        found.append(np.stack([d[good], (start - base)[good], length[good], q[good]], axis=1))
    if not found:
        return none
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    # Of equal stretches the smallest period is the run; its multiples have the same ends.
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[fresh]
    runs[:, 0] = due[runs[:, 0]]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


@dataclass(frozen=True)
class Planted:
    """Repeats that the query puts into every tenth document, by a checksum of its number."""

    def places(self, doc_id, n: int) -> np.ndarray | None:
        """Which word stands at each place; None where the document stays as it is."""
        if doc_id is None or not n:
            return None
        h = zlib.crc32(str(doc_id).encode())
        if h % 10:
            return None
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        i = np.arange(n)
        return np.where(i < a, i, a + (i - a) % p)


def _numbers(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word of all texts, equal for equal words only."""
    flat = pa.array([w for words in texts for w in words], pa.binary())
    return flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether a word is kept: none of its runs has it after the first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 1] + runs[:, 3], 1)
    np.add.at(depth, runs[:, 1] + runs[:, 2], -1)
    return np.cumsum(depth[:-1]) == 0


def collapse_runs(documents: DataFrame, planted: Planted | None = None, shortest: int = SHORTEST) -> DataFrame:
    """All runs of words of each document, and its text with each run cut to one period.

    Returns doc_id, runs (start, length, period in words, by start, then period) and collapsed, the kept words joined
    by one space. `documents` has doc_id, handed on as it is (nulls and repeated ids too), and text; other columns are
    not read. A null, empty or blank text has no runs and an empty collapsed text; no rows give no rows. Texts are used whole;
    memory follows a slice of about 1 MB of text, or one text that is longer. Ties have no part: all runs come.
    With `planted`, repeats are put in first; a null doc_id has none.
    """
    out = T.StructType([
        T.StructField("doc_id", documents.schema["doc_id"].dataType),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType()),
    ])
    given = share(documents.sparkSession, (planted, shortest))
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planted, shortest = given.value
        for batch in text_slices(batches, "text"):
            data, offsets = text_bytes(batch.column(1))
            content = data.tobytes()
            texts = []
            ids = batch.column(0).to_pylist()
            for k, doc_id in enumerate(ids):
                words = content[offsets[k] : offsets[k + 1]].split()
                places = planted.places(doc_id, len(words)) if planted else None
                texts.append(words if places is None else [words[i] for i in places.tolist()])
            first = np.concatenate([[0], np.cumsum([len(words) for words in texts], dtype=np.int64)])
            runs = find_runs(_numbers(texts), first, shortest)
            bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
            collapsed = []
            for k, words in enumerate(texts):
                if bounds[k] < bounds[k + 1]:
                    kept = _kept_words(len(words), runs[bounds[k] : bounds[k + 1]])
                    words = [words[i] for i in np.flatnonzero(kept).tolist()]
                collapsed.append(b" ".join(words).decode())
            structs = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(run_type))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), structs)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(collapsed, pa.string())], names=out.names)

    return documents.select("doc_id", "text").mapInArrow(task, out)
