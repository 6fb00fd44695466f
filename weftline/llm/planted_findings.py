"""Labelled findings by construction: values of a known kind, put into sentences.

A value is drawn as a secret or as something that looks like one, then written into a text. Its label comes from the draw
alone; the features are those of the candidate that the scan finds in the text, so no rule over features makes a label.
"""

from __future__ import annotations

import base64
import random

import pyarrow as pa

HEX, ALNUM = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
# Texts around secrets and around other values.
SECRET_TEXTS = (
    'token = "{}"', "password: {}", "api_key={}", '{{"secret":"{}","user":"bob"}}', "export SECRET_KEY={}", "Authorization: Bearer {}",
    "https://x.example.com/a?user=al&access_token={}", "the password is {} for now", "log in with passphrase {}", "auth_token: '{}'",
    "db://admin:{}@db.example.com/main", "pwd={};", "credentials {}", "TOKEN = {}",
)
HASH_TEXTS = (
    "commit {}", "sha256: {}", "md5={}", "checksum {}", '"etag":"{}"', "revision {}", 'digest = "{}"', "hash {} of the file", "sha1sum {}",
    "image@sha256:{}", "fixed in {}", "/static/{}.js",
)
OTHER_TEXTS = ("{}", "see {}", "ref {}", "order {}", 'id: "{}"', "version={}", "from {} on", "serial {}", '{{"name":"{}"}}', "({})")
PLACEHOLDER_TEXTS = ("password: {}", "token={}", 'api_key = "{}"', "secret: {}", '{{"password":"{}"}}')


def _some(draw: random.Random, letters: str, n: int) -> str:
    return "".join(draw.choice(letters) for _ in range(n))


def secret_value(draw: random.Random, words: list[str]) -> tuple[str, bool]:
    """A secret, and whether it is told by itself, without any text around it."""
    kind = draw.randrange(6)
    if kind == 0:
        return _some(draw, draw.choice([HEX, HEX.upper()]), draw.choice([24, 32, 40, 48, 64])), False
    if kind == 1:
        return base64.b64encode(draw.randbytes(draw.choice([16, 24, 30, 32, 48, 64]))).decode(), False
    if kind == 2:
        return _some(draw, ALNUM, draw.randint(16, 44)), False
    if kind == 3:
        start, n = draw.choice([("ghp_", 36), ("AKIA", 16), ("sk_live_", 24), ("xoxb-", 30), ("AIza", 35), ("glpat-", 20)])
        return start + _some(draw, ALNUM[:26] + "234567" if start == "AKIA" else ALNUM, n), True
    if kind == 4:
        return draw.choice(words).capitalize() + _some(draw, "0123456789", draw.randint(2, 4)) + draw.choice("!#$%*") + _some(draw, ALNUM, draw.randint(0, 5)), False
    return _some(draw, ALNUM + "!#$%*-_", draw.randint(8, 15)) + _some(draw, "0123456789", 2), False


def hash_value(draw: random.Random) -> str:
    return _some(draw, HEX, draw.choice([12, 16, 32, 40, 40, 64]))


def other_value(draw: random.Random, words: list[str]) -> str:
    """What scans take for secrets by its digits, case or length, and isn't one."""
    digits = lambda n: _some(draw, "0123456789", n)
    word = lambda: draw.choice(words)
    made = [
        lambda: f"{_some(draw, HEX, 8)}-{_some(draw, HEX, 4)}-{_some(draw, HEX, 4)}-{_some(draw, HEX, 4)}-{_some(draw, HEX, 12)}",
        lambda: f"20{digits(2)}-0{draw.randint(1, 9)}-{draw.randint(10, 28)}T{draw.randint(10, 23)}:{digits(2)}",
        lambda: f"{digits(1)}.{digits(2)}.{digits(1)}-{word()}.{digits(1)}",
        lambda: f"+1-{digits(3)}-{digits(3)}-{digits(4)}",
        lambda: digits(draw.randint(8, 16)) + draw.choice(["", "", "%%%", "$$$", "###"]),
        lambda: ".".join(str(draw.randint(1, 254)) for _ in range(4)) + draw.choice(["", "", ":8080", "***", "&&&"]),
        lambda: f"{word()}.{digits(2)}@{word()}.example.com",
        lambda: f"https://{word()}.example.org/{word()}/{digits(4)}?page={digits(1)}",
        lambda: f"/usr/{word()}/{word()}{digits(1)}/{word()}.txt",
        lambda: f"{word()}{word().capitalize()}{word().capitalize()}{word().capitalize()}",
        lambda: f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
        lambda: f"{word()}_{word()}_{digits(2)}",
        lambda: f"{word().upper()}{word().upper()}{word().upper()}{word().upper()}",
        lambda: f"{word()}{digits(draw.randint(1, 4))}",
    ]
    return draw.choice(made)()


def placeholder(draw: random.Random, words: list[str]) -> str:
    return draw.choice([
        "changeme", "x" * draw.randint(6, 20), "*" * draw.randint(6, 12), "your-" + draw.choice(words) + "-here", "required", "example",
        "string", "null", "redacted", "forgotten", "0" * draw.randint(8, 16), "${" + draw.choice(words).upper() + "}", draw.choice(words),
    ])


def sentences(n: int, vocabulary: list[str], seed: int = 29) -> list[tuple[str, str, int]]:
    """(text, value, label) of n planted values, about half of them secrets."""
    draw, out = random.Random(seed), []
    common = [w for w in vocabulary if 4 <= len(w) <= 9]
    for _ in range(n):
        choice = draw.random()
        if choice < 0.5:
            value, told = secret_value(draw, common)
            text, label = "{}" if told and draw.random() < 0.3 else draw.choice(SECRET_TEXTS), 1
        elif choice < 0.66:
            value, text, label = hash_value(draw), draw.choice(HASH_TEXTS), 0
        elif choice < 0.74:
            value, text, label = placeholder(draw, common), draw.choice(PLACEHOLDER_TEXTS), 0
        else:
            value, text, label = other_value(draw, common), draw.choice(OTHER_TEXTS), 0
        around = [" ".join(draw.choice(common) for _ in range(draw.randint(0, 6))) for _ in range(2)]
        out.append((f"{around[0]} {text.format(value)} {around[1]}", value, label))
    return out


def texts_of(planted: list[tuple[str, str, int]]) -> pa.Array:
    return pa.array([text for text, _, _ in planted], pa.string())
