"""Candidates for secrets inside runs without white space."""

import base64
import hashlib
import random
import string

import pyarrow as pa

from weftline.llm import secret_scan
from weftline.llm.common import text_bytes

KEY = "24be9a01c77f3d5e8a"


def found(*texts):
    data, offsets = text_bytes(pa.array(texts))
    raw = data.tobytes()
    return {(t, raw[offsets[t] + a : offsets[t] + b].decode(), key.decode()) for t, a, b, key, _, _ in secret_scan.candidates(data, offsets)}


def test_parts_of_a_run_are_candidates():
    texts = {
        f'{{"user":"bob","token":"{KEY}"}}': "token", f'{{"password":"{KEY}"}}': "password", f"user='al',password='{KEY}'": "password",
        f"see https://x.com/cb?user=al&token={KEY} now": "token", f"7,bob,{KEY},x": "", f"ñ a=1;secret:{KEY}}}": "secret",
    }
    for text, key in texts.items():
        assert (0, KEY, key) in found(text)
    assert (0, "dGVzdHRlc3QxMg==", "key") in found('{"key":"dGVzdHRlc3QxMg=="}')


def test_any_value_under_a_name_of_secrets_is_a_candidate():
    for text in ("password=letmein; go", '"password" : "letmein",', "{'db_password':'letmein'}", "password:\n letmein"):
        assert {v for _, v, _ in found(text)} == {"letmein"}
    assert not found("colour=letmein", "password:", "letmein")
    assert secret_scan.form_label(b"hunter2", b"password") is None and secret_scan.form_label(b"12345678", b"token") is None


def test_secrets_in_one_run_are_redacted(spark, vocabulary):
    words = secret_scan.dictionary(vocabulary)
    draw = random.Random(3)
    keys = ["".join(draw.choice("0123456789abcdef") for _ in range(18)) for _ in range(40)]
    rows = [(k, f"the men talk password={h} of maps and sha1: {h[::-1]} at 10.2.3.{k} or mail{k}@old.example.com") for k, h in enumerate(keys)]
    rows += [(100, f'so {{"user":"bob","token":"{KEY}"}} end'), (101, f"so https://x.com/cb?user=al&token={KEY} end"), (102, f"so user='al',password='{KEY}' end")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    forest = secret_scan.fit(secret_scan.labelled_findings(documents, words))
    texts = {r.doc_id: r.text for r in secret_scan.redact(documents, forest, words).collect()}
    assert all(KEY not in texts[k] and texts[k].count("[SECRET]") == 1 and texts[k].startswith("so ") and texts[k].endswith(" end") for k in (100, 101, 102))


def test_copies_of_a_finding_train_once(spark, vocabulary):
    words, method = secret_scan.dictionary(vocabulary), secret_scan.SecretForest(findings=20)
    values = [f"{k}a{KEY}" for k in range(30)]
    first = min(values, key=lambda v: int.from_bytes(hashlib.blake2b(f"{v}|password".encode(), digest_size=8).digest(), "little", signed=True))
    rows = [(f"so password={v} end",) for v in [first] * 300 + values]  # the copied value has the smallest hash
    copies = secret_scan.labelled_findings(spark.createDataFrame(rows, "text string").repartition(3), words, method).collect()
    distinct = secret_scan.labelled_findings(spark.createDataFrame(sorted(set(rows)), "text string"), words, method).collect()
    assert len(copies) == 10 and sorted(copies) == sorted(distinct)


def held_out(draw):
    """(text, value, is secret): forms, names and sentences that the planted findings of training don't have."""
    letters = string.ascii_letters + string.digits
    some = lambda alphabet, n: "".join(draw.choice(alphabet) for _ in range(n))
    key = lambda: draw.choice([some("0123456789abcdef", 56), base64.urlsafe_b64encode(draw.randbytes(40)).decode().rstrip("="), some(letters, 26)])
    password = lambda: draw.choice(["Blue", "tiger", "Summer", "rain"]) + some("!#$%", 1) + some(string.digits, 3) + some(letters, 4)
    secrets = (
        ("we set the db_password = {} for the new host", password), ("mysql://root:{}@10.0.0.4:3306/shop is up", password),
        ("my passphrase was {} until May", password), ("client_secret: {}", key), ('<add key="secret-token" value="{}"/>', key),
        ("curl -H 'Authorization: token {}' here", key), ("AWS_SECRET_ACCESS_KEY={}", key), ('{{"credential":"{}","age":3}}', key),
        ("?id=7&session_token={}&x=1", key), ("-----BEGIN RSA PRIVATE KEY-----{}-----END RSA PRIVATE KEY-----", lambda: "\n" + "\n".join(some(letters + "+/", 64) for _ in range(6)) + "\n"),
    )
    others = (
        ("git tag points at commit {} now", lambda: some("0123456789abcdef", 40)), ("SHA256 {}  setup.exe", lambda: some("0123456789abcdef", 64)),
        ("md5 = {}", lambda: some("0123456789abcdef", 32)), ("seen at {}", lambda: f"10.{draw.randint(0, 255)}.{draw.randint(0, 255)}.7"),
        ("write to {}", lambda: f"jo{draw.randint(10, 99)}@post.example.com"), ("call {}", lambda: f"+44-{some(string.digits, 4)}-{some(string.digits, 6)}"),
        ("uuid {}", lambda: "-".join(some("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))), ("card {} expires", lambda: some(string.digits, 16)),
        ("use {} of it", lambda: draw.choice(["getUserNameFromSession", "parseHttpHeaderValue", "utf8mb4_general_ci", "x86_64-linux-gnu"]) + some(string.digits, 1)),
        ("password: {}", lambda: draw.choice(["required", "********", "xxxxxxxx", "changeme"])), ("at https://old.example.net/{}", lambda: f"notes/{some(string.digits, 6)}"),
        ("isbn {}", lambda: f"978-0-{some(string.digits, 3)}-{some(string.digits, 5)}-1"), ("on {} at noon", lambda: f"19{some(string.digits, 2)}-11-{draw.randint(10, 30)}"),
    )
    for forms, is_secret in ((secrets, True), (others, False)):
        for text, value in forms:
            for _ in range(40):
                v = value()
                yield f"the men look at maps {text.format(v)} and go on", v, is_secret


def test_held_out_findings(spark, vocabulary):
    words = secret_scan.dictionary(vocabulary)
    rows = list(held_out(random.Random(17)))
    nothing = spark.createDataFrame([], "text string")
    forest = secret_scan.fit(secret_scan.labelled_findings(nothing, words), planted=secret_scan.planted_rows(words))
    documents = spark.createDataFrame([(k, text) for k, (text, _, _) in enumerate(rows)], "doc_id long, text string")
    found = {k: [] for k in range(len(rows))}
    for r in secret_scan.scan(documents, forest, words).filter("is_secret").collect():
        found[r.doc_id].append((r.start, r.end))
    hit, missed, false = 0, [], []
    for k, (text, value, is_secret) in enumerate(rows):
        a = text.index(value)
        if is_secret:
            covered = any(s <= a and a + len(value) <= e for s, e in found[k])
            hit += covered
            missed += [] if covered else [text]
        elif found[k]:
            false.append(text)
    recall, precision = hit / (hit + len(missed)), hit / (hit + len(false))
    print("recall", recall, "precision", precision, missed[:8], false[:8])
    assert recall >= 0.9 and precision >= 0.9


def test_odd_private_keys_and_urls():
    begin = "-----BEGIN PRIVATE KEY-----"
    assert not any(key == "private_key" for _, _, key in found(begin * 3, f"x -----END PRIVATE KEY----- {begin}", f"{begin}-----END PRIVATE KEY-----"))
    assert (1, "\nAB\n", "private_key") in found(begin, f"é {begin}\nAB\n-----END PRIVATE KEY-----")
    assert (0, "hello", "password") in found("see ftp://bob:hello@host/x") and not found("see ftp://bob@host/x", "a://b:c d@e")
