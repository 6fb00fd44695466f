"""Secrets in texts: candidates by their form, and a random forest that removes the false positives.

A candidate is a run of characters with digits or changing case, as keys and passwords are, a quoted or delimited part of
such a run, or whatever is assigned to a name of secrets. The forest looks at its length, the
transitions between its characters, how much of it dictionary words cover, the path it stands in, and its neighbouring
words, and is trained on labelled findings: planted ones, whose labels come from how they were made, and those of the
corpus. Where the name before a corpus value gave its label, the forest is shown the value without its surroundings.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import planted_findings
from weftline.llm.common import fresh, record_batch, share, text_bytes, text_slices, word_spans

_LEAST, _CONTEXT = 8, 64
_DIGIT = np.zeros(256, dtype=np.int64)
_DIGIT[0x30:0x3A] = 1
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[0x61:0x7B] = True
_VALUE = re.compile(rb"[A-Za-z0-9+/_\-.~!@#$%^&*]{8,}={0,2}")
_KEYED = re.compile(rb"""^["'(\[{<]*([A-Za-z][A-Za-z0-9_.\-]*)(=|:)["']?(.+)$""", re.S)
_NAME = re.compile(rb"""([A-Za-z][A-Za-z0-9_.\-]*)\\?["'`]?\s*[=:]{1,2}>?\s*\\?["'`]?$""")
_ASSIGNED = re.compile(rb"""[=:]{1,2}>?\s*\\?["'`]?""")
_QUOTED = re.compile(rb"""(["'`])(.+?)\1""", re.S)
_DIVIDES = re.compile(rb"""["'`=:&,;{}()\[\]<>\\]""")
_PIECE = re.compile(rb"""[^"'`=:&,;{}()\[\]<>\\]+(?:={1,2}(?=["'`&,;{}()\[\]<>\\]|$))?""")
_EDGE = b"\"'`,;:.!?()[]{}<>"
_TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")
# The password in the authority of a URL, and the marks around a private key, by their public formats.
_USERINFO = re.compile(rb"://[^\x20\x09-\x0D:@/]*:([^\x20\x09-\x0D@/]+)@")
_KEY_BEGIN = re.compile(rb"-----BEGIN [A-Z0-9 ]{0,32}PRIVATE KEY(?: BLOCK)?-----")
_KEY_END = b"-----END "
# Words that stand beside secrets, and words that stand beside other long strings.
_SECRET_WORDS = set(
    b"password passwd pwd pass passphrase secret token key apikey api_key access_key secret_key private_key client_secret "
    b"auth authorization bearer credential credentials cookie session signature aws_secret_access_key".split()
)
_OTHER_WORDS = set(
    b"sha sha1 sha256 md5 checksum digest commit revision hash etag uuid guid id isbn doi version build serial phone tel fax "
    b"order invoice ref example sample http https www mailto url".split()
)
# Forms of well-known keys, from their public descriptions, and the label that they give.
_SECRET_FORMS = [
    re.compile(rb"A(?:KIA|SIA)[A-Z2-7]{16}"), re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}"), re.compile(rb"xox[abprs]-[A-Za-z0-9-]{10,}"),
    re.compile(rb"AIza[A-Za-z0-9_\-]{35}"), re.compile(rb"sk_(?:live|test)_[A-Za-z0-9]{16,}"), re.compile(rb"glpat-[A-Za-z0-9_\-]{20}"),
]
_OTHER_FORMS = [
    re.compile(rb"[^@]+@[^@]+\.[A-Za-z]+"), re.compile(rb"(?:https?:|www\.|/).*"),
    re.compile(rb"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"), re.compile(rb"(.)\1*"),
]
# Under a name of secrets these forms tell nothing.
_PLAIN_FORMS = [re.compile(rb"[0-9][0-9.\-/+:]*"), re.compile(rb"[A-Za-z]+[0-9]{1,4}"), re.compile(rb"[A-Z]+")]


@dataclass(frozen=True)
class SecretForest:
    """Parameters: findings of the corpus that train the forest at most, planted findings, trees, depth, least rows of a leaf,
    least share of votes for a secret."""

    findings: int = 6000
    planted: int = 3000
    trees: int = 32
    depth: int = 8
    leaf: int = 3
    threshold: float = 0.5


@dataclass(frozen=True)
class Lexicon:
    """Dictionary words, and the log probabilities of one letter after another in them."""

    words: frozenset[bytes]
    moves: np.ndarray

    def __contains__(self, word: bytes) -> bool:
        return word in self.words

    def fluency(self, value: bytes) -> float:
        """The mean log probability of the letter pairs of a value; that of no pair if it has none."""
        codes = np.frombuffer(value.lower(), np.uint8).astype(np.int64) - 0x61
        pair = (codes[:-1] >= 0) & (codes[:-1] < 26) & (codes[1:] >= 0) & (codes[1:] < 26)
        return float(self.moves[codes[:-1][pair], codes[1:][pair]].mean()) if pair.any() else -9.0


def dictionary(vocabulary: str, least: int = 3) -> Lexicon:
    """Whole words of a public tokenizer's vocabulary (a file of fixed size): letters only, with its end-of-word mark."""
    import json

    words = json.loads(vocabulary)["model"]["vocab"]
    mark = json.loads(vocabulary)["model"].get("end_of_word_suffix") or ""
    plain = (w.removesuffix(mark) for w in words if w.endswith(mark))
    words = frozenset(w.lower().encode() for w in plain if len(w) >= least and w.isascii() and w.isalpha())
    counts = np.ones((26, 26))
    for word in words:
        codes = np.frombuffer(word, np.uint8).astype(np.int64) - 0x61
        np.add.at(counts, (codes[:-1], codes[1:]), 1)
    return Lexicon(words, np.log(counts / counts.sum(axis=1, keepdims=True)))


def _is_secret_name(key: bytes) -> bool:
    key = key.lower()
    return key in _SECRET_WORDS or not _SECRET_WORDS.isdisjoint(re.split(rb"[_.\-]", key))


def _parts(word: bytes) -> list[tuple[int, int]]:
    """Quoted parts of a run, and its delimited parts without marks at their ends."""
    if not _DIVIDES.search(word):
        return []
    out = {m.span(2) for m in _QUOTED.finditer(word)}
    for m in _PIECE.finditer(word):
        part = m.group().lstrip(_EDGE)
        a = m.end() - len(part)
        if len(part) % 4:  # the sign of an assignment, not the padding of a key
            part = part.rstrip(b"=")
        out.add((a, a + len(part.rstrip(_EDGE))))
    return sorted(s for s in out if s[0] < s[1])


def _looks_random(value: bytes) -> bool:
    """Long enough, with a digit or many changes of case or capitals: what the filter of whole runs asks for."""
    if len(value) < _LEAST or not _VALUE.search(value):
        return False
    if re.search(rb"[0-9]", value):
        return True
    return len(value) >= 16 and (len(re.findall(rb"[a-z](?=[A-Z])", value)) >= 2 or len(re.findall(rb"[A-Z]", value)) >= 15)


def candidates(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, bytes, bytes, bytes]]:
    """(text, start, end, key, before, after): places in bytes of the text, the name it is assigned to, and its neighbours.

    A run without white space is one candidate, and each quoted or delimited part of it another one; they may overlap.
    So are the password in a URL and all between the marks of a private key; without its end mark a key has only its lines.
    """
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return []
    digits = np.append(np.cumsum(_DIGIT[data]), 0)
    count = digits[ends - 1] - np.where(starts > 0, digits[starts - 1], 0)
    turn = np.zeros(len(data) + 1, np.int64)
    turn[1:-1] = _LOWER[data[:-1]] & _UPPER[data[1:]]
    turns = np.cumsum(turn)
    inner = turns[ends - 1] - turns[starts]
    capitals = np.cumsum(_UPPER[data])
    large = capitals[ends - 1] - capitals[starts]
    wanted = (ends - starts >= _LEAST) & ((count > 0) | (((inner >= 2) | (large >= 15)) & (ends - starts >= 16)))
    raw, out = data.tobytes(), []
    # What is assigned to a name of secrets is a candidate in any form.
    signs = np.flatnonzero((data == 0x3D) | (data == 0x3A))
    tops = offsets[np.searchsorted(offsets, signs, side="right") - 1]
    named = np.zeros(len(starts), bool)
    for at, top in zip(signs.tolist(), tops.tolist(), strict=True):
        name = _NAME.search(raw[max(top, at - _CONTEXT) : at + 1])
        if name and _is_secret_name(name.group(1)):
            w = int(np.searchsorted(ends, _ASSIGNED.match(raw, at).end(), side="right"))
            if w < len(starts) and np.searchsorted(offsets, starts[w], side="right") == np.searchsorted(offsets, at, side="right"):
                named[w] = True
    passwords: dict[int, list[tuple[int, int]]] = {}
    for m in _USERINFO.finditer(raw):
        w = int(np.searchsorted(ends, m.start(1), side="right"))
        if w < len(starts) and starts[w] <= m.start() and m.end() <= ends[w]:
            passwords.setdefault(w, []).append(m.span(1))
            named[w] = True
    chosen = np.flatnonzero(wanted | named)
    owner = np.searchsorted(first, chosen, side="right") - 1
    for t, w in zip(owner.tolist(), chosen.tolist(), strict=True):
        low, high = int(starts[w]), int(ends[w])
        top, bottom = int(offsets[t]), int(offsets[t + 1])
        word, key, a = raw[low:high], b"", low
        keyed = _KEYED.match(word)
        if keyed and not keyed.group(3).startswith(b"//"):
            key, a = keyed.group(1), low + keyed.start(3)
        after = raw[high : min(bottom, high + _CONTEXT)]
        found: dict[tuple[int, int], tuple[bytes, bytes, bytes]] = {}

        for x, y in passwords.get(w, ()):
            found[x, y] = b"password", raw[max(top, x - _CONTEXT) : x], raw[y : min(bottom, y + _CONTEXT)]

        def add(a: int, b: int, key: bytes, before: bytes, after: bytes, whole: bool) -> None:
            if not key:
                spoken = _NAME.search(before)
                key = spoken.group(1) if spoken else b""
            value = raw[a:b]
            shaped = (wanted[w] and len(value) >= _LEAST and _VALUE.search(value)) if whole else _looks_random(value)
            if value and (shaped or (named[w] and _is_secret_name(key))):
                found.setdefault((a, b), (key, before, after))

        before = raw[max(top, a - _CONTEXT) : a]
        lead = raw[a:high]
        rest = lead.lstrip(_EDGE)
        own = a + len(lead) - len(rest)
        add(own, own + len(re.split(rb"[\"']", rest)[0].rstrip(_EDGE)), key, before, after, True)
        for x, y in _parts(word):
            add(low + x, low + y, b"", raw[max(top, low + x - _CONTEXT) : low + x], raw[low + y : min(bottom, low + y + _CONTEXT)], False)
        out += [(t, x - top, y - top, *found[x, y]) for x, y in sorted(found)]
    return out + _private_keys(raw, offsets)


def _private_keys(raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, int, bytes, bytes, bytes]]:
    out, done = [], 0
    for m in _KEY_BEGIN.finditer(raw):
        t = int(np.searchsorted(offsets, m.start(), side="right")) - 1
        top, bottom = int(offsets[t]), int(offsets[t + 1])
        if m.start() < done or m.end() > bottom:
            continue
        end = raw.find(_KEY_END, m.end(), bottom)
        done = bottom if end < 0 else end  # without an end here, there is none for a later key of the text
        if end > m.end():
            out.append((t, m.end() - top, end - top, b"private_key", raw[max(top, m.end() - _CONTEXT) : m.end()], raw[end : min(bottom, end + _CONTEXT)]))
    return out


_KINDS = np.zeros(256, np.int64)
for _low, _high, _kind in ((0x30, 0x3A, 1), (0x41, 0x5B, 2), (0x61, 0x7B, 3)):
    _KINDS[_low:_high] = _kind
N_FEATURES = 17 + 16 + 14
_AROUND = slice(N_FEATURES - 7, N_FEATURES)  # features of the name and the neighbouring words


def _covered(value: bytes, words: Lexicon) -> float:
    """The share of characters that lie in dictionary words, longest first from each place."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(14, len(low) - at), 2, -1) if low[at : at + n] in words), 0)
        covered += size
        at += size or 1
    return covered / max(1, len(low))


def features(value: bytes, key: bytes, before: bytes, after: bytes, words: Lexicon) -> list[float]:
    """Shares of character kinds and of transitions between them, and what is named in the text of the module."""
    codes = np.frombuffer(value, np.uint8)
    kinds = _KINDS[codes]
    n = len(codes)
    moves = np.bincount(kinds[:-1] * 4 + kinds[1:], minlength=16) / max(1, n - 1)
    shares = np.bincount(kinds, minlength=4) / n
    counts = np.bincount(codes)
    p = counts[counts > 0] / n
    hexes = sum(c in b"0123456789abcdefABCDEF" for c in value) / n
    key = key.lower()
    parts = set(re.split(rb"[_.\-]", key)) | {key}
    left = [w.strip(_EDGE + b"=").lower() for w in _TOKEN.findall(before)[-4:]]
    right = [w.strip(_EDGE).lower() for w in _TOKEN.findall(after)[:2]]
    near = set(left[-3:]) | set(right)
    return [
        n, np.log2(n), *shares, float(-(p * np.log2(p)).sum()), len(p) / n, hexes, float(np.mean(kinds[1:] != kinds[:-1])) if n > 1 else 0.0,
        _covered(value, words), words.fluency(value), float(max(len(x) for x in re.split(rb"[0-9]", value))), float(max(len(x) for x in re.split(rb"[^0-9]", value))),
        float(value[:1].isalpha()), float(value.endswith(b"=")), float(len(set(value)) <= 2),
        *moves,
        float(b"/" in value), float(value.count(b"/")), float(value.count(b".")), float(value.count(b"-")), float(b"@" in value),
        float(b"://" in value or b"://" in before[-12:]), float(bool(re.search(rb"\.[A-Za-z]{2,4}$", value))),
        float(bool(key)), float(bool(parts & _SECRET_WORDS)), float(bool(parts & _OTHER_WORDS)),
        float(bool(near & _SECRET_WORDS)), float(bool(near & _OTHER_WORDS)), float(before[-1:] in (b'"', b"'")),
        sum(w in words for w in near) / max(1, len(near)),
    ]


def form_label(value: bytes, key: bytes) -> int | None:
    """The label that a well-known form gives: a secret (1), something else (0), or none."""
    if any(f.fullmatch(value) for f in _SECRET_FORMS):
        return 1
    if any(f.fullmatch(value) for f in _OTHER_FORMS):
        return 0
    named = _is_secret_name(key)
    if any(f.fullmatch(value) for f in _PLAIN_FORMS):
        return None if named else 0
    parts = set(re.split(rb"[_.\-]", key.lower())) | {key.lower()}
    if named and len(value) >= 12 and sum(c in b"0123456789" for c in value) >= 3:
        return 1
    return 0 if parts & _OTHER_WORDS else None


def _labelled_by_name(value: bytes) -> bool:
    """Whether a label of form_label can't come from the value."""
    return not any(f.fullmatch(value) for f in (*_SECRET_FORMS, *_OTHER_FORMS, *_PLAIN_FORMS))


class Forest:
    """Classification trees on bootstrap samples, each split chosen among random features by the Gini gain."""

    def __init__(self, x: np.ndarray, y: np.ndarray, method: SecretForest):
        self.method, self.trees = method, []
        draw = np.random.default_rng(13)
        for _ in range(method.trees if len(x) else 0):
            rows = draw.integers(0, len(x), len(x))
            self.trees.append(self._grow(x[rows], y[rows], draw))

    def _grow(self, x: np.ndarray, y: np.ndarray, draw: np.random.Generator) -> np.ndarray:
        """Nodes as rows: feature (-1: leaf), bound, left, right, share of secrets."""
        nodes: list[list[float]] = []

        def split(rows: np.ndarray, depth: int) -> int:
            number = len(nodes)
            nodes.append([-1, 0, 0, 0, float(y[rows].mean())])
            if depth == 0 or len(rows) < 2 * self.method.leaf or y[rows].min() == y[rows].max():
                return number
            best = (0.0, -1, 0.0)
            for f in draw.choice(x.shape[1], max(1, int(np.sqrt(x.shape[1]))), replace=False):
                order = rows[np.argsort(x[rows, f], kind="stable")]
                values, ones = x[order, f], np.cumsum(y[order])
                size = np.arange(1, len(rows))
                a, b = ones[:-1] / size, (ones[-1] - ones[:-1]) / (len(rows) - size)
                impurity = (size * a * (1 - a) + (len(rows) - size) * b * (1 - b)) * 2 / len(rows)
                allowed = (values[1:] > values[:-1]) & (size >= self.method.leaf) & (len(rows) - size >= self.method.leaf)
                if allowed.any():
                    k = int(np.argmin(np.where(allowed, impurity, np.inf)))
                    whole = ones[-1] / len(rows)
                    gain = 2 * whole * (1 - whole) - impurity[k]
                    if gain > best[0]:
                        middle = (values[k] + values[k + 1]) / 2
                        best = (gain, int(f), middle if middle < values[k + 1] else values[k])
            if best[1] >= 0:
                left = x[rows, best[1]] <= best[2]
                nodes[number][:2] = best[1:]
                nodes[number][2] = split(rows[left], depth - 1)
                nodes[number][3] = split(rows[~left], depth - 1)
            return number

        split(np.arange(len(x)), self.method.depth)
        return np.array(nodes)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """The mean share of secrets in the leaves; 0.5 without any training rows."""
        total = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.method.depth):
                f = tree[at, 0].astype(np.int64)
                go = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= tree[at, 1], tree[at, 2], tree[at, 3])
                at = np.where(f < 0, at, go).astype(np.int64)
            total += tree[at, 4]
        return total / len(self.trees) if self.trees else np.full(len(x), 0.5)


def _found(texts: pa.Array, words: Lexicon):
    """The candidates of the texts, their values, and their features."""
    data, offsets = text_bytes(texts)
    found = candidates(data, offsets)
    raw = data.tobytes()
    values = [raw[offsets[t] + a : offsets[t] + b] for t, a, b, *_ in found]
    table = [features(v, *f[3:], words) for v, f in zip(values, found, strict=True)]
    return data, offsets, found, values, np.array(table, float).reshape(len(found), N_FEATURES)


def labelled_findings(documents: DataFrame, words: Lexicon, method: SecretForest = SecretForest()) -> DataFrame:
    """features, label, by_name of findings whose form or name tells what they are, one of each value and key.

    `by_name` says that the name before the value gave the label. There are at most so many of each label, those with the
    smallest hashes.
    """
    given, most = share(documents.sparkSession, words), method.findings // 2
    schema = pa.schema([("label", pa.int32()), ("order", pa.int64()), ("features", pa.list_(pa.float64())), ("by_name", pa.bool_())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[dict, dict] = {}, {}  # of each label: features and what gave it by order, the smallest ones
        for batch in text_slices(batches, "text"):
            _, _, found, values, table = _found(batch.column(0), given.value)
            labels = [form_label(v, f[3]) for v, f in zip(values, found, strict=True)]
            rows = [k for k, label in enumerate(labels) if label is not None]
            order = [int.from_bytes(hashlib.blake2b(values[k] + b"|" + found[k][3], digest_size=8).digest(), "little", signed=True) for k in rows]
            for k, at in zip(rows, order, strict=True):
                own = kept[labels[k]]
                if at not in own or table[k].tolist() < own[at][0]:
                    own[at] = table[k].tolist(), _labelled_by_name(values[k])
            for own in kept:
                if len(own) > 2 * most:
                    for at in sorted(own)[most:]:
                        del own[at]
        for label, own in enumerate(kept):
            chosen = sorted(own)[:most]
            yield record_batch(schema, [label] * len(chosen), chosen, [own[at][0] for at in chosen], [own[at][1] for at in chosen])

    findings = documents.select("text").mapInArrow(task, "label int, order long, features array<double>, by_name boolean")
    single = findings.groupBy("label", "order").agg(F.min("features").alias("features"), F.min("by_name").alias("by_name"))
    each = [single.filter(F.col("label") == c).orderBy("order").limit(most) for c in (0, 1)]
    return each[0].unionByName(each[1]).select("features", "label", "by_name")


def planted_rows(words: Lexicon, method: SecretForest = SecretForest(), seed: int = 29) -> list[tuple[list[float], int]]:
    """features, label of the planted findings that the scan takes for candidates, and of other candidates in their texts."""
    planted = planted_findings.sentences(method.planted, sorted(w.decode() for w in words.words), seed)
    _, _, found, values, table = _found(planted_findings.texts_of(planted), words)
    out = []
    for f, value, row in zip(found, values, table.tolist(), strict=True):
        _, wanted, label = planted[f[0]]
        if value == wanted.encode():
            out.append((row, label))
        elif wanted.encode() not in value and value not in wanted.encode():  # a run around the value, or a part of it, has no label
            out.append((row, 0))
    return out


def fit(findings: DataFrame, method: SecretForest = SecretForest(), planted: list[tuple[list[float], int]] = ()) -> Forest:
    """Train on labelled findings of the corpus, of which there is a bounded number, and on planted ones.

    With planted findings, a corpus value whose name gave its label is shown without its surroundings; without them, names
    can be learned from the corpus alone.
    """
    rows = [(list(features), label) for features, label in planted]
    for features, label, by_name in findings.select("features", "label", "by_name").collect():
        features = list(features)
        if by_name and planted:
            features[_AROUND] = [0.0] * 7
        rows.append((features, label))
    rows.sort()
    x = np.array([r[0] for r in rows], float).reshape(len(rows), N_FEATURES)
    return Forest(x, np.array([r[1] for r in rows], float), method)


def scan(documents: DataFrame, forest: Forest, words: Lexicon) -> DataFrame:
    """doc_id, start, end, name, value_sha256, probability, is_secret of every candidate; one narrow pass.

    `documents` has doc_id and text; other columns are not read. Places are code points of the whole text. A null or
    empty text has no candidates; the same secret twice gives two rows; a run and its parts have a row each; repeated
    rows repeat; a null doc_id stays null; no rows give no rows. Values leave the scan as hashes only.
    """
    given = share(documents.sparkSession, (forest, words))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()),
        ("value_sha256", pa.string()), ("probability", pa.float64()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, words = given.value
        for batch in text_slices(batches, "text"):
            data, offsets, found, values, table = _found(batch.column(1), words)
            if not found:
                continue
            first = (data & 0xC0) != 0x80
            spans = [(int(first[o : o + a].sum()), int(first[o : o + b].sum())) for (t, a, b, *_) in found for o in (int(offsets[t]),)]
            keys = batch.column(0).take(pa.array([f[0] for f in found]))
            hashes = [hashlib.sha256(v).hexdigest() for v in values]
            names = [f[3].decode("ascii", "replace") or None for f in found]
            yield record_batch(schema, keys, [s for s, _ in spans], [e for _, e in spans], names, hashes, pa.array(forest.probabilities(table)))

    kind = "doc_id long, start long, end long, name string, value_sha256 string, probability double"
    rows = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, kind)
    return rows.withColumn("is_secret", F.col("probability") >= forest.method.threshold)


def redact(documents: DataFrame, forest: Forest, words: Lexicon, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with every secret in the text replaced by a mark; a null text stays null."""
    given = share(documents.sparkSession, (forest, words, mark.encode()))
    name = fresh(documents, "redacted")

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        forest, words, mark = given.value
        batch, out = pa.RecordBatch.from_arrays([texts], ["text"]), []
        for part in text_slices(iter([batch]), "text"):
            data, offsets, found, _, table = _found(part.column(0), words)
            now, raw = part.column(0).to_pylist(), data.tobytes()
            secret = forest.probabilities(table) >= forest.method.threshold
            spans: dict[int, list[tuple[int, int]]] = {}
            for f, is_secret in zip(found, secret.tolist(), strict=True):
                if is_secret:
                    spans.setdefault(f[0], []).append((f[1], f[2]))
            for t, pieces in spans.items():
                text, done, new = raw[offsets[t] : offsets[t + 1]], 0, []
                for a, b in sorted(pieces):
                    if a >= done:
                        new += [text[done:a], mark]
                    done = max(done, b)  # candidates may overlap
                now[t] = b"".join([*new, text[done:]]).decode("utf-8")
            out += now
        return pa.array(out, pa.string())

    return documents.withColumn(name, cleaned(F.col("text"))).withColumn("text", F.col(name)).drop(name)
