import hashlib
import random
import re
import time
from collections import Counter

import pytest

from pitlane.llm.secret_scan import BASE, KINDS, MASK, mask_secrets, scan

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
PARTS = ["password", "PassWD", "secret", "token", "api_key", "apikey", '"', "'", " ", "  ", ":",
         "=", "AKIA", "AKIAABCDEFGHIJ1234", "abcdef0123456789", "0123456789abcdef01", "x", "Zz9",
         "😀", "é", "", "\n", "token=abcdefghijklmnop", "aB3dE5gH7jK9mN1pQ3sT5vW7xY9zA2cD4f",
         "client_id=app-77 ", "user: bob", "https://api.example.com/v1?x=1", "-", ".", "/",
         "secret: short", "x" * 150, ""]


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def every(text):
    weak = [(m.start(), n, m.end()) for n in range(len(BASE), len(KINDS))
            for m in re.finditer(KINDS[n].pattern, text)
            if KINDS[n].keep is None or re.search(KINDS[n].keep, m[0])]
    parts, found = base(text) + weak, base(text)
    for start, n, end in weak:
        near = {KINDS[p[1]].role for p in parts if p[0] - 200 <= end and start <= p[2] + 200}
        needed = {"secret": {"identifier"}, "identifier": {"secret"},
                  "endpoint": {"secret", "identifier"}}[KINDS[n].role]
        if needed <= near:
            found.append((start, n, end))
    return sorted(found)


def written(spans):
    return ",".join(f"{KINDS[n].name}:{start}:{end}" for start, n, end in spans)


def masked(text):
    at, out = 0, ""
    for start, _, end in every(text):
        if start >= at and end > at:
            out += text[at:start] + MASK
        at = max(at, end)
    return out + text[at:]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    made = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(500)]
    odd = [(None, "token=abcdefghijklmnop"), (None, None), (3000, ""), (3000, None),
           (3001, "password=abcdefghijkl" * 300), (3001, "password=abcdefghijkl" * 300),
           (3002, "user: bob " + "z " * 300 + "aB3dE5gH7jK9mN1pQ3sT5vW7xY9zA2cD4f")]
    return list(enumerate(made)) + odd


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, len(t or ""), "x", 1, None) for i, t in rows],
        "doc_id long, text string, n_chars int, digest string, start int, linked string",
    ).repartition(3)


def test_every_document(docs, rows):
    expected = Counter()
    for i, text in rows:
        spans = base(text or "")
        counts = [sum(s[1] == n for s in spans) for n in range(3)]
        digest = hashlib.sha256(written(spans).encode()).hexdigest()
        expected[i, *counts, digest, written(every(text or ""))] += 1
    assert Counter(map(tuple, scan(docs).collect())) == expected
    assert any("mixed" in e[-1] for e in expected) and any("endpoint" in e[-1] for e in expected)


def test_weak_parts_alone_are_not_reported(spark):
    texts = ["user: bob", "see https://example.com/x", "aB3dE5gH7jK9mN1pQ3sT5vW7xY9zA2cD4f",
             "user: bob and aB3dE5gH7jK9mN1pQ3sT5vW7xY9zA2cD4f at https://example.com"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in scan(docs).collect()}
    assert [found[i] for i in range(3)] == ["", "", ""]
    assert [part.split(":")[0] for part in found[3].split(",")] == ["identifier", "mixed", "endpoint"]


def test_masking(docs, rows):
    out = mask_secrets(docs)
    assert out.columns == docs.columns
    expected = Counter(
        (i, None if t is None else masked(t), len(masked(t or "")) if every(t or "") else len(t or ""))
        for i, t in rows)
    assert Counter((r.doc_id, r.text, r.n_chars) for r in out.collect()) == expected


def test_no_python_runs(docs):
    plan = scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(empty):
    assert scan(empty).collect() == []
    assert mask_secrets(empty).collect() == []


def many(spark, count):
    text = " ".join(f"AKIA{n:016} user: bob{n} aB3dE5gH7jK9mN1pQ3sT5vW7xY9zA{n:08}" for n in range(count))
    return spark.createDataFrame([(1, text)], "doc_id long, text string"), text


def test_many_matches_in_one_text(spark):
    docs, text = many(spark, 1500)
    found = scan(docs).collect()[0]
    assert found.spans == written(every(text)) and found.n_access == 1500
    assert mask_secrets(docs).collect()[0].text == masked(text)


def test_time_is_linear_in_the_matches(spark):
    def seconds(count):
        docs, _ = many(spark, count)
        begin = time.monotonic()
        scan(docs).collect()
        mask_secrets(docs).collect()
        return time.monotonic() - begin

    seconds(1000)
    assert seconds(33_000) < 60  # about 100,000 matches
