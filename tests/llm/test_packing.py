import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pitlane.llm.bpe import VOCABULARY
from pitlane.llm.packing import cut, pack, sum_of_squares
from .support import document_table


def test_documents_are_cut_into_full_sequences_after_the_first():
    assert list(cut(10, 16)) == [(0, 10)]
    assert list(cut(16, 16)) == [(0, 16)]
    assert list(cut(37, 16)) == [(0, 5), (5, 16), (21, 16)]


def test_placing_by_the_rule_itself():
    """Each placement against a plain search over all open sequences."""
    r = np.random.default_rng(3)
    for _ in range(20):
        sizes, length = r.integers(1, 30, 60), 30
        places, offsets = sum_of_squares(sizes, length)
        gaps = {}
        for i in np.argsort(-sizes, kind="stable"):
            size, place = int(sizes[i]), int(places[i])

            def total(changed):
                return sum(n * n for g, n in Counter(changed.values()).items() if g)

            after = {p: total({**gaps, p: gaps[p] - size}) for p in gaps if gaps[p] >= size}
            if after:
                assert after[place] == min(after.values())
                gaps[place] -= size
            else:
                assert place not in gaps
                gaps[place] = length - size
            assert offsets[i] == length - gaps[place] - size
        assert min(gaps.values()) >= 0


def test_few_sequences_are_wasted():
    sizes = np.random.default_rng(1).integers(1, 1024, 8000)
    places, _ = sum_of_squares(sizes, 1024)
    assert places.max() + 1 <= 1.003 * sizes.sum() / 1024 + 2


@pytest.mark.parametrize("group", [1 << 16, 7])
def test_every_piece(edge, group):
    rows, docs = edge
    library = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        for n, (start, length) in enumerate(cut(len(ids), 1024)):
            data = struct.pack(f"<{length}I", *ids[start:start + length])
            expected[i, n, start, length, zlib.crc32(data)] += 1
    found = pack(docs, group=group).collect()
    assert Counter(tuple(r[:5]) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(r.length for r in found) // 1024)
    if group > 100:
        assert len(sequences) <= least + 2


def test_empty(empty):
    assert pack(empty).collect() == []


def test_runs_of_over_a_million_spaces(spark):
    rows = [(0, "a" + " " * 1_200_000 + "b"), (1, "\n" * 1_200_000), (2, "x" + " \t\u3000" * 400_000),
            (3, " " * 150_000 + "y"), (4, "short")]
    library = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for i, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        for n, (start, length) in enumerate(cut(len(ids), 1024)):
            data = struct.pack(f"<{length}I", *ids[start:start + length])
            expected[i, n, start, length, zlib.crc32(data)] += 1
    found = pack(document_table(spark, rows)).collect()
    assert Counter(tuple(r[:5]) for r in found) == expected
