"""Personal data by bootstrapped extraction from contexts.

Base forms (addresses, numbers that pass their checks) are always reported, and are the seeds. What
stands beside a seed, a word with the signs between, is a lexical pattern. A graph links patterns to the
values that they introduce, seeds and candidates of a wider form alike: addresses without a dotted
host, addresses of the long kind, numbers without a plus or that fail their check.

Spark scores the graph in rounds. A pattern is trusted if it introduces several different known values
and its word, wherever it stands in the corpus, introduces a known value more often than not. A candidate
becomes known if the trusted patterns beside it make it likely enough, and then supports patterns
itself. The rounds end when nothing is added. Every place of a known value is reported, so a number
that is written out in full once is found in another spelling elsewhere.

Texts are read twice, for values and for words; the rounds move values as digests and never texts.
"""

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pitlane.llm.common import stage
from pitlane.operators.joins import attach_small

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)

#: Different known values that a trusted pattern introduces, at least.
SUPPORT = 3
#: How often its word does introduce a known value, of all its places.
PRECISION = 0.5
#: Likelihood at which a candidate becomes known.
ACCEPT = 0.8
#: No pattern is more certain than this.
SURE = 0.99
#: Longest word and longest gap of a pattern, in characters.
LONGEST_WORD, LONGEST_GAP = 32, 3
#: Different words that a task counts before it hands them on.
COUNTED = 200_000

# The base forms and their limits.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match starts at the first digit of a run and ends with the last, so no digit is read twice.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = range(16, 20), range(8, 16)

# Wider forms of candidates.
_NEAR_AT = re.compile(r"[^\s@<>()\",;:]{1,253}")
_HEX_IP = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_NUMBER = re.compile(r"\(?[0-9](?:[\x20().-]{0,2}[0-9])+")
WIDE_CARD, WIDE_PHONE = range(12, 20), range(7, 16)

_DIGITS = re.compile("[0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")
_DIGIT = re.compile(r"\d")

Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Each @ with the signs before it, up to the last match, and the host after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            yield EMAIL, start, end
        else:
            end = at  # no sign before this @ is looked at again
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the base forms, by kind and start, in time linear in the text."""
    spans = list(_emails(text))
    for m in _IP.finditer(text):
        if all(int(part.lstrip("0")[:4] or 0) <= 255 for part in m[0].split(".")):
            spans.append((IP, *m.span()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.findall(m[0])
        if len(digits) in CARD_DIGITS and _luhn("".join(digits)):
            spans.append((CARD, *m.span()))
    if "+" in text:
        spans += [(PHONE, *m.span()) for m in _PHONE.finditer(text)
                  if len(_DIGITS.findall(m[0])) in PHONE_DIGITS]
    return spans


def candidate_spans(text: str, base: list[Span]) -> list[Span]:
    """Wider forms in what base forms leave of a text."""
    spans, begin = [], 0
    taken = sorted((start, end) for _, start, end in base)
    for start, end in [*taken, (len(text), len(text))]:
        if start > begin:
            spans += _candidates(text, begin, start)
        begin = max(begin, end)
    return spans


def _candidates(text: str, begin: int, end: int) -> Iterator[Span]:
    at, last = text.find("@", begin, end), begin
    while at >= 0:
        start = at
        while start > max(last, at - 64) and not (text[start - 1].isspace()
                                                  or text[start - 1] in "@<>()\",;:"):
            start -= 1
        host = _NEAR_AT.match(text, at + 1, end)
        if host and start < at:
            last = host.end()
            yield EMAIL, start, last
        at = text.find("@", max(at + 1, last), end)
    for m in _HEX_IP.finditer(text, begin, end):
        yield IP, *m.span()
    for m in _NUMBER.finditer(text, begin, end):
        digits = len(_DIGITS.findall(m[0]))
        if digits in WIDE_CARD:
            yield CARD, *m.span()
        if digits in WIDE_PHONE:
            yield PHONE, *m.span()


def value_of(kind: int, found: str) -> bytes:
    """What all spellings of a value share, as a digest."""
    plain = "".join(_DIGITS.findall(found)) if kind in (CARD, PHONE) else found.lower()
    return hashlib.blake2b(plain.encode(), digest_size=16).digest()


def _letter(sign: str) -> bool:
    return sign.isalnum() and not sign.isdecimal()


def _pattern(side: str, word: str, gap: str) -> tuple[str, str]:
    word = word.lower()
    return word, f"{side}|{word}|{_DIGIT.sub('0', _SPACE.sub(' ', gap))}"


def contexts(text: str, start: int, end: int) -> list[tuple[str, str]]:
    """(word, pattern) to the left and to the right of a span, where a word is near."""
    found = []
    near = start
    while near > 0 and start - near <= LONGEST_GAP and not _letter(text[near - 1]):
        near -= 1
    far = near
    while far > 0 and near - far <= LONGEST_WORD and _letter(text[far - 1]):
        far -= 1
    if start - near <= LONGEST_GAP and 0 < near - far <= LONGEST_WORD:
        found.append(_pattern("L", text[far:near], text[near:start]))
    near = end
    while near < len(text) and near - end <= LONGEST_GAP and not _letter(text[near]):
        near += 1
    far = near
    while far < len(text) and far - near <= LONGEST_WORD and _letter(text[far]):
        far += 1
    if near - end <= LONGEST_GAP and 0 < far - near <= LONGEST_WORD:
        found.append(_pattern("R", text[near:far], text[end:near]))
    return found


# --- reading texts ------------------------------------------------------------------------------

_SPAN = "kind:int,start:int,end:int"
_CONTEXT = T.StructType([T.StructField("word", T.StringType()),
                         T.StructField("pattern", T.StringType())])
_PLACE = T.StructType([
    *[T.StructField(c, T.IntegerType()) for c in ("kind", "start", "end")],
    T.StructField("value", T.BinaryType()), T.StructField("base", T.BooleanType()),
    T.StructField("contexts", T.ArrayType(_CONTEXT))])


def _places(docs: DataFrame) -> DataFrame:
    """doc_id and every base form and candidate of each text, with value and contexts."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("places", T.ArrayType(_PLACE))])
    arrow = to_arrow_schema(schema)

    def found(text: str) -> list[dict]:
        base = base_spans(text)
        return [
            {"kind": kind, "start": start, "end": end, "value": value_of(kind, text[start:end]),
             "base": n < len(base),
             "contexts": [{"word": w, "pattern": p} for w, p in contexts(text, start, end)]}
            for n, (kind, start, end) in enumerate([*base, *candidate_spans(text, base)])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [found(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(places, arrow.field("places").type)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, n), several rows per word: how often words stand anywhere, counted task by task."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    arrow = to_arrow_schema(schema)

    def listed(tokens: Counter) -> pa.RecordBatch:
        words: Counter = Counter()
        for token, n in tokens.items():
            for word in _WORD.findall(token):
                if len(word) <= LONGEST_WORD:
                    words[word.lower()] += n
        return pa.RecordBatch.from_arrays(
            [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())],
            schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                tokens.update((text.as_py() or "").split())
                if len(tokens) >= COUNTED:
                    yield listed(tokens)
                    tokens.clear()
        yield listed(tokens)

    return docs.select("text").mapInArrow(run, schema)


# --- rounds -------------------------------------------------------------------------------------

_VALUE = ["kind", "value"]
_PATTERN = ["kind", "pattern"]


def _trusted(links: DataFrame, known: DataFrame, support: int, precision: float) -> DataFrame:
    """(kind, pattern, confidence) of the patterns that known values support."""
    of_known = attach_small(links, known, _VALUE, "left_semi")
    return (
        of_known.groupBy(*_PATTERN)
        .agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n"), F.max("total").alias("total"))
        .withColumn("confidence", F.round(F.least(F.col("n") / F.col("total"), F.lit(SURE)), 9))
        .filter((F.col("values") >= support) & (F.col("confidence") >= precision))
        .select(*_PATTERN, "confidence")
    )


def known_values(
    links: DataFrame, seeds: DataFrame, support: int = SUPPORT, precision: float = PRECISION,
    accept: float = ACCEPT,
) -> DataFrame:
    """(kind, value) of the seeds and of all that the rounds add to them.

    `links` has one row per kind, value and pattern, with n, how often they meet, and total, the places
    of the pattern's word. A pattern that a third of all links share is reduced before it is shuffled,
    and what is joined back to links is broadcast or, beyond a checked size, salted.
    """
    known = stage(seeds.select(*_VALUE).distinct(), "known")
    while True:
        trusted = stage(_trusted(links, known, support, precision), "trusted")
        unsure = attach_small(
            attach_small(links, trusted, _PATTERN), known, _VALUE, "left_anti")
        likely = 1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))
        added = stage(
            unsure.groupBy(*_VALUE).agg(F.round(likely, 9).alias("likely"))
            .filter(F.col("likely") >= accept).select(*_VALUE), "added")
        if added.isEmpty():
            return known
        known = stage(known.unionByName(added), "known")


def _links(places: DataFrame, docs: DataFrame, support: int) -> DataFrame:
    """The graph: kind, value, pattern, n, total; without patterns of too few values to be trusted."""
    each = places.select(F.explode("places").alias("p"))
    met = stage(
        each.select("p.kind", "p.value", F.explode("p.contexts").alias("c"))
        .groupBy("kind", "value", F.col("c.pattern").alias("pattern"), F.col("c.word").alias("word"))
        .agg(F.count(F.lit(1)).alias("n")), "met")
    shared = stage(met.groupBy(*_PATTERN, "word").count().filter(F.col("count") >= support), "shared")
    words = stage(shared.select("word").distinct(), "words")
    totals = stage(
        attach_small(_word_counts(docs), words, ["word"], "left_semi")
        .groupBy("word").agg(F.sum("n").alias("total")), "totals")
    patterns = stage(attach_small(shared, totals, ["word"]).select(*_PATTERN, "total"), "patterns")
    return stage(attach_small(met.drop("word"), patterns, _PATTERN), "links")


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _is(kind: int) -> Callable[[Column], Column]:
    """Null for every other kind."""
    return lambda found: F.when(found == kind, found)


def personal_data(
    docs: DataFrame, support: int = SUPPORT, precision: float = PRECISION, accept: float = ACCEPT,
) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest are of the base forms; spans are these and what the rounds discover, as
    kind:start:end in characters, by kind and start, joined with commas. Base forms of one kind never
    overlap, those of two kinds may; what is discovered never overlaps a base form. A null or empty
    text has none. Rows stay as they are, repeated or without an id; other columns are not read.
    """
    # Written with a number for each row, by which what is discovered comes back to it.
    places = stage(_places(docs).withColumn("row", F.monotonically_increasing_id()), "places")
    each = places.select("row", F.explode("places").alias("p"))
    known = known_values(_links(places, docs, support), each.filter("p.base").select("p.kind", "p.value"),
                         support, precision, accept)
    found = attach_small(
        each.filter("NOT p.base").select("row", "p.kind", "p.value", "p.start", "p.end"),
        known, _VALUE, "left_semi",
    ).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("found"))
    # Not broadcast by the size of the files of places, which are far smaller than what is found in them.
    found = found.hint("merge")
    none = F.array().cast(f"array<struct<{_SPAN}>>")
    base = F.array_sort(F.transform(F.filter("places", lambda p: p["base"]), lambda p: F.struct(
        p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"))))
    both = places.select("doc_id", "row", base.alias("base")).join(found, "row", "left")
    counts = [F.size(F.array_compact(F.transform("base.kind", _is(n)))).cast("long").alias(f"n_{name}")
              for n, name in enumerate(KINDS)]
    every = F.array_sort(F.concat("base", F.coalesce("found", none)))
    return both.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
                       _written(every).alias("spans"))
