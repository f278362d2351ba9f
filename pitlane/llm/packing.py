"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

A document longer than a sequence is cut into full sequences, the rest being its first piece. What
is shorter than a sequence is dealt out to groups of bounded size, and each group is packed in one
task: the longest piece first, each goes where the sum over all residual gaps of the squared number
of open sequences with that gap becomes smallest. That keeps gaps of all sizes at hand for what
comes later. A sequence is opened only if no open one has room.
"""

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pitlane.llm.bpe import VOCABULARY, Encoder, encoder_of, vocabulary_file
from pitlane.llm.common import stage

SEQUENCE = 1024
END = 2
#: Pieces that one task packs; a group leaves some sequences open, a few in ten thousand at this size.
GROUP = 1 << 16
#: The library gives up on a run of about a million white-space characters; from here on it isn't used.
LONG_RUN = 100_000
_LONG_RUN = re.compile(r"\s{%d}" % LONG_RUN)


def cut(length: int, sequence: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, after a shorter first one if need be."""
    first = length % sequence
    if first:
        yield 0, first
    for start in range(first, length, sequence):
        yield start, sequence


def sum_of_squares(sizes: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (0, 1, ...) and the offset in it of each piece, all shorter than a sequence."""
    gaps = np.zeros(sequence + 1, np.int64)  # how many open sequences have each residual gap
    open_at: list[list[int]] = [[] for _ in range(sequence + 1)]
    places, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    opened = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        from_ = gaps[size:]
        to = gaps[:sequence + 1 - size].copy()
        to[0] = 0  # full sequences are not open
        # Half of what the sum of squares changes by when one goes from a gap to a smaller one.
        change = to - from_ + 1.0
        change[0] -= 0.5
        change[from_ == 0] = np.inf
        best = int(change.argmin())
        if np.isfinite(change[best]):
            gap = size + best
            place = open_at[gap].pop()
            gaps[gap] -= 1
        else:
            gap, place = sequence, opened
            opened += 1
        places[i], offsets[i] = place, sequence - gap
        if gap > size:
            gaps[gap - size] += 1
            open_at[gap - size].append(place)
    return places, offsets


@cache
def _tokens(spec: str) -> Callable[[str], np.ndarray]:
    """Texts to ids by a library that merges as the vocabulary does, and several times faster than
    Python can; it is built once per Python worker. Texts that it can't take go to the exact encoder."""
    encoder = encoder_of(spec)
    vocabulary = encoder.vocabulary
    ranks = {word.encode("latin-1"): i for i, word in enumerate(vocabulary.words)}
    added = {token: len(ranks) + i for i, token in enumerate(vocabulary.added)}
    library = tiktoken.Encoding(
        "packing", pat_str=Encoder.PIECES, mergeable_ranks=ranks, special_tokens=added)
    ids = np.array([*vocabulary.ids, *vocabulary.added.values()], "<u4")

    def encode(text: str) -> np.ndarray:
        if len(text) < LONG_RUN or not _LONG_RUN.search(text):
            try:
                return ids[library.encode_to_numpy(text, allowed_special="all")]
            except ValueError:
                pass
        return np.frombuffer(encoder.encode_bytes(text), "<u4")

    return encode


def pieces(
    docs: DataFrame, sequence: int = SEQUENCE, end: int = END, path: str = VOCABULARY,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and `deal`, a number of its own for every piece.

    A null text counts as empty and is one piece that holds the end id only.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary_file(path))
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("piece", T.IntegerType()),
        *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "deal")],
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, closing = _tokens(spec.value), int(end).to_bytes(4, "little")
        deal = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            rows, taken = [], []
            for i in range(batch.num_rows):
                tokens = ids_of(texts[i].as_py() or "").tobytes() + closing
                for n, (start, length) in enumerate(cut(len(tokens) // 4, sequence)):
                    part = tokens[4 * start:4 * (start + length)]
                    rows.append((n, start, length, zlib.crc32(part), deal))
                    taken.append(i)
                    deal += 1
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(taken, pa.int64()))]
                + [pa.array(c, arrow.field(1 + n).type) for n, c in enumerate(columns)],
                schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(
    docs: DataFrame, sequence: int = SEQUENCE, end: int = END, path: str = VOCABULARY,
    group: int = GROUP,
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Offsets in a sequence have
    no gaps. Repeated rows are packed as often as they come, a null doc_id like any other, equal
    sizes in the order dealt. An empty table gives an empty one; other columns are not read. Texts
    are encoded once: the pieces are written to the shared folder and packed from there.
    """
    cut_up = stage(pieces(docs, sequence, end, path), "pieces")
    full = F.col("length") == sequence
    short = cut_up.filter(~full)
    groups = -(-short.count() // group) or 1
    schema = T.StructType([
        *cut_up.schema.fields, T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("deal", ignore_index=True)
        number = int(rows.pop("group")[0])
        places, offsets = sum_of_squares(rows["length"].to_numpy(), sequence)
        # Sequences of groups are even, full pieces odd; neither can meet another's.
        return rows.assign(sequence_id=2 * (places * groups + number), offset=offsets)

    packed = (
        short.withColumn("group", F.pmod(F.xxhash64("deal"), F.lit(groups)))
        .groupBy("group").applyInPandas(place, schema)
    )
    whole = cut_up.filter(full).withColumns({
        "sequence_id": 2 * F.col("deal") + 1, "offset": F.lit(0).cast("long")})
    return packed.unionByName(whole).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
