import gzip
import hashlib
import uuid
from collections import Counter
from pathlib import Path

import pytest

from pitlane.llm.warc import archive_pages, follow, read_archive, resolve, write_archive

SCHEMA = "page_id long, url string, html string, digest string, size long, copy int"
LONG = "<html>" + "x" * 200 + "</html>"
ROWS = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (None, "http://a/n", LONG),
    (4, "http://a/4", "short"), (6, "http://a/6", "short"), (7, "http://a/7", None),
    (8, "http://a/8", ""), (10, "bad\r\nWARC-Type: forged", "é" * 50),
    (11, "u", "é" * 50), (12, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n\r\n" * 9),
    (13, "u", "y" * 99), (14, "u", "y" * 99), (15, "u", "z" * 300_000), (16, "u", "z" * 300_000),
    (20, "same", LONG + "twice"), (20, "same", LONG + "twice"), (20, "other", LONG + "twice"),
    (None, None, "n" * 200), (None, None, "n" * 200),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in ROWS], SCHEMA).repartition(3)


def expected():
    groups = {}
    for i, _, html in ROWS:
        groups.setdefault(html or "", []).append(i)
    out = Counter()
    for html, ids in groups.items():
        data = html.encode()
        digest, n = hashlib.sha256(data).hexdigest(), len(data)
        ids = sorted(ids, key=lambda i: (i is None, i))
        for place, i in enumerate(ids):
            again = n >= 100 and place > 0
            out[i, n, digest, "revisit" if again else "response", ids[0] if again else None] += 1
    return out


def test_every_page(pages):
    assert Counter(map(tuple, archive_pages(pages).collect())) == expected()


def test_archive_on_disk(pages, spark, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    write_archive(pages, path, "2026-01-02T03:04:05Z")
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in Path(path).glob("*.gz"))
    assert raw.count(b"WARC-Type: forged") == 0
    assert raw.count(b"WARC-Date: 2026-01-02T03:04:05Z") == len(ROWS)
    assert raw.count(LONG.encode() + b"\r\n\r\n") == 1
    found = read_archive(spark, path, payloads=True)
    payloads = Counter(bytes(r.payload).decode() for r in found.collect() if r.payload is not None)
    assert payloads[LONG] == 1 and payloads["short"] == 2 and payloads[""] == 2
    ids = [r.record_id for r in found.collect()]
    assert len(set(ids)) == len(ids) - 0
    assert follow(found).filter("record_type = 'revisit' and refers_to_id is null").count() == 0


def test_damage_is_an_error(spark, tmp_path, pages):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    write_archive(pages.filter("page_id = 5").coalesce(1), path)
    file = next(Path(path).glob("*.gz"))
    (Path(path) / f".{file.name}.crc").unlink(missing_ok=True)
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"xxx", b"xyx", 1)))
    with pytest.raises(Exception, match="damaged"):
        read_archive(spark, path).collect()


def test_headers_alone_resolve(spark):
    headers = spark.createDataFrame(
        [(2, "u2", "d", 500), (1, "u1", "d", 500), (3, "u3", "e", 10), (4, "u4", "e", 10)],
        "page_id long, uri string, digest string, size long")
    found = {r.page_id: r.original and r.original.page_id for r in resolve(headers).collect()}
    assert found == {1: 1, 2: 1, 3: None, 4: None}


def test_empty(spark):
    assert archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []
