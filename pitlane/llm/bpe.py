"""Byte-level BPE: exact encoding by backtracking in linear time, decoding by an offset table.

A sequence of tokens is the result of the merges if and only if every two neighbours are compatible:
merging their joined bytes gives just these two. So the longest token matches, found by an
Aho-Corasick automaton, are taken from the left, and one that doesn't fit its neighbour gives way to
the next shorter prefix; a place from which no token fits is marked and never tried again. Whether
two tokens are compatible is looked up in a table that fills as pairs are met.

The vocabulary is read from a file of the tokenizers library.
"""

import hashlib
import json
import re

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pitlane.llm.common import REMEMBERED, Remembered, map_texts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Tokens that are decoded at once.
BLOCK = 1 << 16


def _byte_letters() -> dict[str, str]:
    """The letter that the vocabulary file writes for a byte -> the character of that number.

    Bytes with a printable Latin-1 character stand for themselves, the others follow from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): chr(b) for b in shown} | {
        chr(256 + i): chr(b) for i, b in enumerate(hidden)
    }


class Vocabulary:
    """Tokens by rank: the 256 bytes, then the merges in order. Bytes are held as Latin-1 text."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                 "byte_fallback", "ignore_merges")
        added = spec["added_tokens"]
        if (
            spec["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"]
            or not split["use_regex"] or any(model.get(k) for k in plain)
            or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added)
        ):
            raise ValueError("only plain byte-level vocabularies are read")
        letters = _byte_letters()
        spell = lambda token: "".join(letters[c] for c in token)
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.words = sorted(letters.values()) + [spell(a + b) for a, b in merges]
        self.rank = {word: i for i, word in enumerate(self.words)}
        if len(self.rank) != len(self.words):
            raise ValueError("two merges give the same token")
        ids = {spell(token): i for token, i in model["vocab"].items()}
        self.ids = [ids[word] for word in self.words]
        self.parts = [(i, i) for i in range(256)]
        self.parts += [(self.rank[spell(a)], self.rank[spell(b)]) for a, b in merges]
        self.merged = {pair: i for i, pair in enumerate(self.parts) if i > 255}
        self.added = {a["content"]: a["id"] for a in added}
        by_id = {i: word.encode("latin-1") for i, word in zip(self.ids, self.words, strict=True)}
        by_id |= {i: content.encode() for content, i in self.added.items()}
        size = max(by_id) + 1
        self.bytes = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(size)), np.uint8)
        lengths = [len(by_id.get(i, b"")) for i in range(size)]
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens: each is a slice of one buffer, found by its offset."""
        out = []
        for at in range(0, len(ids), BLOCK):
            block = ids[at:at + BLOCK]
            starts = self.offsets[block]
            lengths = self.offsets[block + 1] - starts
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
            out.append(self.bytes[places].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class Encoder:
    """Texts to token ids, exactly as the merges give them."""

    #: Fixed value: how the vocabulary's makers cut texts before merging.
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    _PIECES = regex.compile(PIECES)
    #: A space before a character that isn't one always begins a piece.
    _OTHER_SPACES = re.compile(r" (?!\S)")
    _CUTS = re.compile(r" (?=\S)")

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for i, word in enumerate(v.words):
            self.automaton.add_word(word, i)
        self.automaton.make_automaton()
        self.lengths = [len(word) for word in v.words]
        self.id_bytes = [int(i).to_bytes(4, "little") for i in v.ids]
        self.shorter: dict[int, int] = {}
        self.fitting: dict[tuple[int, int], bool] = {}
        self.pieces = Remembered(self.piece)
        self.chunks = Remembered(self.after_space)
        self.added = v.added and re.compile("|".join(
            re.escape(a) for a in sorted(v.added, key=len, reverse=True)))

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens together leaves just these two."""
        found = self.fitting.get((left, right))
        if found is None:
            if len(self.fitting) >= REMEMBERED:
                self.fitting.clear()
            found = self.fitting[left, right] = self._undisturbed(left, right)
        return found

    def _undisturbed(self, left: int, right: int) -> bool:
        """Undo the later of both tokens' merges again and again.

        If the parts that meet at the seam merge, and do so before the merge that was undone last,
        that merge would never have happened.
        """
        merged, parts = self.vocabulary.merged, self.vocabulary.parts
        before = len(parts)
        while True:
            if merged.get((left, right), before) < before:
                return False
            if left > right:  # the left token was made later
                if left < 256:
                    return True
                before, left = left, parts[left][1]
            else:
                if right < 256:
                    return True
                # Of equal merges the left one comes first.
                before, right = right + 1, parts[right][0]

    def _prefix(self, token: int) -> int:
        """The longest token that the token properly begins with, or -1."""
        found = self.shorter.get(token)
        if found is None:
            word, rank = self.vocabulary.words[token], self.vocabulary.rank
            found = next((rank[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in rank), -1)
            self.shorter[token] = found
        return found

    def _backtrack(self, piece: str) -> list[int]:
        lengths, size = self.lengths, len(piece)
        longest = [0] * size
        for end, token in self.automaton.iter(piece):  # longer ones of a start come later
            longest[end + 1 - lengths[token]] = token
        out: list[int] = []
        dead, at, token = bytearray(size + 1), 0, longest[0]
        while True:
            end = at + lengths[token]
            if not dead[end] and (not out or self.fits(out[-1], token)):
                out.append(token)
                at = end
                if at == size:
                    return out
                token = longest[at]
            elif (shorter := self._prefix(token)) >= 0:
                token = shorter
            else:
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]

    def piece(self, piece: str) -> bytes:
        """The ids, four bytes each, of one piece."""
        latin = piece.encode().decode("latin-1")
        whole = self.vocabulary.rank.get(latin)
        tokens = [whole] if whole is not None else self._backtrack(latin)
        return b"".join([self.id_bytes[t] for t in tokens])

    def chunk(self, chunk: str) -> bytes:
        """The ids of a text without added tokens."""
        return b"".join([self.pieces[p] for p in self._PIECES.findall(chunk)])

    def after_space(self, rest: str) -> bytes:
        """The ids of a space and what follows it."""
        if rest.isalpha():
            return self.pieces[" " + rest]
        if rest[-1:] in (",", ".") and rest[:-1].isalpha():
            return self.pieces[" " + rest[:-1]] + self.pieces[rest[-1]]
        return self.chunk(" " + rest)

    def _stretch(self, text: str) -> bytes:
        cuts = self._CUTS.split(text) if self._OTHER_SPACES.search(text) else text.split(" ")
        first = self.chunk(cuts[0])
        del cuts[0]
        return first + b"".join(map(self.chunks.__getitem__, cuts))

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self.added:
            return self._stretch(text)
        out, at = [], 0
        for found in self.added.finditer(text):
            out.append(self._stretch(text[at:found.start()]))
            out.append(int(self.vocabulary.added[found[0]]).to_bytes(4, "little"))
            at = found.end()
        out.append(self._stretch(text[at:] if at else text))
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4").astype(np.int64)


_encoders: dict[str, Encoder] = {}


def encoder_of(spec: str) -> Encoder:
    """The encoder of a vocabulary file's content, built once per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(Vocabulary(spec))
    return _encoders[key]


def vocabulary_file(path: str = VOCABULARY) -> str:
    """The content of a vocabulary file, a few MB; the driver reads it for all executors."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(docs: DataFrame, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The other columns of docs and `ids`, the tokens of the whole text as an array of integers.

    A null or empty text has no tokens. Rows stay as they are, repeated or not; docs must not have
    another column `ids`.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary_file(path))

    def start():
        encoder = encoder_of(spec.value)
        return lambda text: (encoder.encode(text),)

    return map_texts(docs, text, [T.StructField("ids", T.ArrayType(T.IntegerType()))], start)


def decode_documents(docs: DataFrame, ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """The other columns of docs and `text`, what the tokens stand for; null or no tokens: empty.

    Bytes that are no UTF-8 become replacement characters. An id beyond the vocabulary is an error.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary_file(path))
    kept = [f for f in docs.schema.fields if f.name != ids]
    schema = T.StructType([*kept, T.StructField("text", T.StringType())])

    def run(batches):
        vocabulary = encoder_of(spec.value).vocabulary
        for batch in batches:
            texts = [
                vocabulary.decode(np.asarray(row.as_py() or [], np.int64)) for row in batch.column(ids)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(texts, pa.string())],
                [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def token_digests(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Per document the number of tokens and digests of the ids and of the text decoded from them.

    Encoded and decoded again in one pass, so ids aren't moved. A null text counts as empty: no
    tokens, digests of nothing. Rows stay as they are; other columns than doc_id are not read.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary_file(path))
    fields = [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def start():
        encoder = encoder_of(spec.value)

        def digests(text: str) -> tuple:
            ids = encoder.encode_bytes(text)
            decoded = encoder.vocabulary.decode(np.frombuffer(ids, "<u4").astype(np.int64))
            return (
                len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )

        return digests

    return map_texts(docs.select("doc_id", "text"), "text", fields, start)
