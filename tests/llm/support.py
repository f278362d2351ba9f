"""Rows that the tests share."""

import random

#: Columns of a documents table, and others with names that operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard int, "
          "digest string, rows long, row long, kept boolean, __id long, score double, ids string")
WORDS = "the and idiot sun is a good day for Xy Zebra trees ofthe running water stone".split()


def texts(seed=1, count=60):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 60))) for _ in range(count)]


def edge_rows():
    """Ordinary texts, copies, near copies, null and empty texts, null and repeated ids, ties."""
    plain = texts()
    rows = list(enumerate(plain))
    rows += [(100 + i, t) for i, t in enumerate(plain[:10])]
    rows += [(200 + i, t.replace(" ", "\t\n ", 1)) for i, t in enumerate(plain[:10])]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, None), (None, plain[0]), (None, None),
             (None, "no id here"), (304, "long word " * 30_000), (305, "long word " * 30_000),
             (306, "q" * 50_000), (20, plain[20]), (20, plain[20]), (20, "another text of twenty"),
             (307, "Ünïcode 😀 日本語 text"), (308, "one")]
    return rows


def document_table(spark, rows):
    filled = [(i, t, "en", f"src{n % 3}", None if t is None else len(t), n, "x", 1, 2, True, 7, 0.5,
               None) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(filled, SCHEMA)
