"""Token ids of whole texts with a public tokenizer, each distinct word encoded once."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from weftline.llm.common import LOWER, text_bytes

#: Words whose ids a worker remembers, and the ids that go with them; beyond, it keeps those that came in several slices.
REMEMBERED = 300_000
#: Plain words that go to the model in one string.
_JOINED = 64

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x61:0x7B] = _LETTER[0x41:0x5B] = True
# ASCII marks after which, or before which, a run of letters ends; the apostrophe isn't one.
_MARK = np.zeros(256, dtype=bool)
_MARK[np.frombuffer(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~', np.uint8)] = True
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x0A]] = True
# Latin letters with one lower case and one composed form; the multiplication and division signs aren't.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[a-z{_LATIN}]+")


class Encoder:
    """Ids of texts by a tokenizer file that drops white space, lowers case, splits letters from marks and ends words by a suffix.

    A text is cut at spaces, line feeds and between ASCII letters and marks, where that tokenizer cuts too, and its
    pieces are encoded once for each distinct one. Texts with strings of special tokens are cut at white space only.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.of_plain = Tokenizer.from_str(vocabulary)  # takes lower-case words and cuts at spaces only
        self.of_plain.normalizer = None
        self.of_plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.tokenizer.model.end_of_word_suffix
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.closes = np.fromiter(((self.tokenizer.id_to_token(k) or "").endswith(suffix) for k in range(size)), bool, size)
        self.known: dict[str, int] = {}
        self.uses = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _forget(self) -> None:
        """Keep the words that came in more than one slice since the last time, if they are half of the words at most."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > REMEMBERED // 2:
            keep = keep[:0]
        words = list(self.known)  # in the order of their rows
        sizes = self.sizes[keep]
        ends = np.cumsum(sizes)
        self.flat = self.flat[np.arange(sizes.sum()) + np.repeat(self.starts[keep] - ends + sizes, sizes)]
        self.starts, self.sizes, self.uses = ends - sizes, sizes, np.zeros(len(keep), np.int32)
        self.known = {words[k]: row for row, k in enumerate(keep.tolist())}

    def _plain_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words of plain letters, and how many each has: the last one of a word closes it."""
        joined = [" ".join(words[k : k + _JOINED]).lower() for k in range(0, len(words), _JOINED)]
        encoded = self.of_plain.encode_batch_fast(joined, add_special_tokens=False)
        flat = np.array([i for one in encoded for i in one.ids], np.uint32)
        return flat, np.diff(np.flatnonzero(self.closes[flat]), prepend=-1)

    def _learn(self, words: list[str]) -> None:
        plain, rest = [], []
        for word in words:
            (plain if word.isascii() and word.isalpha() or _PLAIN.fullmatch(word) else rest).append(word)
        flat, sizes = self._plain_ids(plain)
        encoded = [one.ids for one in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        sizes = np.concatenate([sizes, np.fromiter(map(len, encoded), np.int64, len(encoded))])
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int32)])
        self.flat = np.concatenate([self.flat, flat, np.fromiter(chain.from_iterable(encoded), np.uint32)])
        self.known.update(zip(plain + rest, range(len(self.known), len(self.known) + len(words)), strict=True))

    def _rows(self, words: list[str]) -> np.ndarray:
        """Rows of the distinct words of a slice."""
        if len(self.known) + len(words) > REMEMBERED:
            self._forget()
        rows = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(rows < 0).tolist()
        if new:
            self._learn([words[k] for k in new])
            rows[new] = [self.known[words[k]] for k in new]
        self.uses[rows] += 1
        return rows

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the offsets of each text; `end_id` closes every text. A null is empty."""
        data, offsets = text_bytes(texts)
        n_texts = len(offsets) - 1
        inside = ~_SEPARATOR[data]
        if data.tobytes().find(b"<|") >= 0:  # as in the strings of special tokens
            letter = mark = np.zeros(len(data), dtype=bool)
        else:
            data = LOWER[data]
            letter, mark = _LETTER[data], _MARK[data]
        starts = inside.copy()
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        starts[1:] &= ~inside[:-1] | (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1]) | first[1:-1]
        places = np.cumsum(inside) - 1  # of each byte among those that are kept
        begin = np.flatnonzero(starts)
        kept = data[inside]
        bounds = np.append(places[begin], len(kept)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(bounds), pa.py_buffer(kept))
        distinct = words.dictionary_encode()
        rows = self._rows(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())[distinct.indices.to_numpy()]
        counts = self.sizes[rows]
        ends = np.concatenate([[0], np.cumsum(counts)])
        word_ends = ends[np.searchsorted(begin, offsets)]
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends[:-1], counts)]
        if end_id is None:
            return ids, word_ends
        closed = np.full(len(ids) + n_texts, end_id, np.uint32)
        keep = np.ones(len(closed), dtype=bool)
        keep[word_ends[1:] + np.arange(n_texts)] = False
        closed[keep] = ids
        return closed, word_ends + np.arange(n_texts + 1)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(vocabulary)


def vocabulary_text(path: str) -> str:
    """A tokenizer file of fixed size (some megabytes); executors get it by broadcast."""
    with open(path, encoding="utf-8") as file:
        return file.read()
