"""Secret scans with linking of credentials that consist of several parts.

Strong candidates (assigned secrets, access keys, long hexadecimal runs) are always reported. Weak
ones could be anything: names of users or clients, web addresses, long mixed strings. They are
reported only where parts that complement each other stand together: candidates of a document are
joined by intervals, and a weak secret needs an identifier within the scope, a weak identifier a
secret, an endpoint both.

Columns only: no Python runs on the executors. Matches are found with their places by putting a
mark around each and measuring what lies between the marks.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import id_keys, plain_text, stage

#: Most characters between two parts of one credential.
SCOPE = 200
#: Characters per bucket of the interval join.
BUCKET = 512
#: A private character that no pattern matches; if a text has it, it is read as the next one.
MARK, OTHER = "\ue000", "\ue001"
MASK = "[secret]"


@dataclass(frozen=True)
class Kind:
    """Matches of `pattern`, leftmost first and not overlapping; those that fail `keep` are dropped.

    `only` matches a text if one of its matches may be kept.
    """

    name: str
    role: str
    pattern: str
    only: str
    keep: str | None = None
    weak: bool = False


# The base patterns, and what a match of each must have.
_ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
           r"[A-Za-z0-9+/_.=-]")
BASE = (
    Kind("assign", "secret", _ASSIGN + "+", _ASSIGN + "{12}",
         r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}"""),
    Kind("access", "identifier", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{14}", "^.{18}"),
    Kind("hex", "secret", "[0-9a-f]{16,}", "[0-9a-f]{16}"),
)
# Long runs of letters and digits that hold capitals, small letters and digits.
_MIXED = r"[A-Za-z0-9+/]{32,}={0,2}"
_NAMED = r"""(?i:access_?key_?id|client_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?"""
WEAK = (
    Kind("identifier", "identifier", _NAMED + r"[A-Za-z0-9@._-]{3,}", _NAMED + r"[A-Za-z0-9@._-]{3}",
         weak=True),
    Kind("endpoint", "endpoint", r"https?://[A-Za-z0-9._:-]+[A-Za-z0-9._:/?&=%-]*",
         r"https?://[A-Za-z0-9._:-]", weak=True),
    Kind("mixed", "secret", _MIXED, r"[A-Za-z0-9+/]{32}",
         r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])", weak=True),
)
KINDS = BASE + WEAK
_SPANS = "array<struct<start:int,kind:int,end:int>>"
#: Items of a list that are folded at a time.
CHUNK = 64


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _some(items: Column, begin: Column, end: Column) -> Column:
    """The items from `begin` on and before `end`, which is larger."""
    return F.transform(F.sequence(begin, end - 1), lambda i: F.get(items, i))


def _folded(
    items: Column, kind: str, emit: Callable[[Column, Column], tuple[Column, Column]],
) -> Column:
    """Walk over a list from place 0 on: the last place, and all that is emitted, as an array.

    `emit` takes the place and an item, and gives the next place and an array of none or some. What is
    emitted is gathered chunk by chunk, so nothing is copied as often as there are items.
    """
    none = F.array().cast(kind)
    # Items are taken one by one: a slice would read the whole list each time.
    chunks = _let(items, lambda every: F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(every) / CHUNK).cast("int") - 1),
        lambda i: _some(every, i * CHUNK, F.least(i * CHUNK + CHUNK, F.size(every)))))

    def one(state: Column, item: Column) -> Column:
        place, out = emit(state["at"], item)
        return F.struct(place.alias("at"), F.concat(state["found"], out).alias("found"))

    def chunk(state: Column, part: Column) -> Column:
        last = state["last"]
        begin = F.struct(last["at"].alias("at"), none.alias("found"))
        return F.struct(F.aggregate(part, begin, one).alias("last"),
                        F.concat(state["found"], F.array(last["found"])).alias("found"))

    start = F.struct(F.struct(F.lit(0).alias("at"), none.alias("found")).alias("last"),
                     F.array().cast(f"array<{kind}>").alias("found"))
    return F.aggregate(
        chunks, start, chunk,
        lambda s: F.struct(s["last"]["at"].alias("at"), F.flatten(
            F.concat(s["found"], F.array(s["last"]["found"]))).alias("found")))


def spans(text: Column, number: int) -> Column:
    """Where the matches of a kind are: array of (start, kind, end) in characters."""
    kind = KINDS[number]
    marked = F.regexp_replace(
        F.translate(text, MARK, OTHER), f"({kind.pattern})", f"{MARK}$1{MARK}")
    # What lies between matches, and every second one a match.
    parts = F.transform(F.split(marked, MARK), lambda part, i: F.struct(
        part.alias("part"), (i % 2 == 1).alias("inside")))

    def emit(at: Column, item: Column) -> tuple[Column, Column]:
        end = at + F.length(item["part"])
        span = F.array(F.struct(at.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        good = item["inside"] & (F.lit(True) if kind.keep is None else item["part"].rlike(kind.keep))
        return end, F.when(good, span).otherwise(F.array().cast(_SPANS))

    found = _folded(parts, _SPANS, emit)["found"]
    return F.when(text.rlike(kind.only), found).otherwise(F.array().cast(_SPANS))


_KEYS = ["id", "no_id", "digest"]


def _keys() -> dict[str, Column]:
    """What tells texts apart, without nulls; rows that agree in it have the same spans."""
    return id_keys("doc_id") | {"digest": F.sha2(plain_text(), 256)}


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, keys of the text, and the spans of the base kinds and of the weak ones."""
    texts = docs.select("doc_id", *[c.alias(n) for n, c in _keys().items()],
                        plain_text().alias("text"))
    found = lambda first, kinds: F.array_sort(F.concat(*[
        spans(F.col("text"), first + i) for i in range(len(kinds))]))
    return texts.select("doc_id", *_KEYS, found(0, BASE).alias("base"),
                        found(len(BASE), WEAK).alias("weak"))


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k.role) for k in KINDS]), kind + 1)


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak candidates that complementary parts stand by: keys and `linked`, an array of spans.

    An interval join: parts reach out by the scope and meet candidates in buckets of places, so a
    text with very many of them is spread as well.
    """
    texts = found.filter(F.size("weak") > 0).dropDuplicates(_KEYS)
    one = lambda spans: texts.select(*_KEYS, F.explode(spans).alias("span")).select(
        *_KEYS, "span.*")
    bucket = lambda place: F.floor(place / BUCKET)
    weak = one(F.col("weak")).withColumn(
        "bucket", F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("end")))))
    parts = (
        one(F.concat("base", "weak"))
        .select(*_KEYS, _role(F.col("kind")).alias("near"), (F.col("start") - scope).alias("from"),
                (F.col("end") + scope).alias("to"))
        .filter("near != 'endpoint'")
        .withColumn("bucket", F.explode(F.sequence(bucket(F.col("from")), bucket(F.col("to")))))
    )
    met = weak.join(parts, [*_KEYS, "bucket"]).filter("`from` <= `end` and start <= `to`")
    about = met.groupBy(*_KEYS, "start", "kind", "end").agg(
        F.max(F.col("near") == "identifier").alias("identifier"),
        F.max(F.col("near") == "secret").alias("secret"))
    role = _role(F.col("kind"))
    whole = (
        F.when(role == "secret", F.col("identifier")).when(role == "identifier", F.col("secret"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return about.filter(whole).groupBy(*_KEYS).agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def _written(spans: Column) -> Column:
    name = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in characters, by start and kind, joined with commas. A null or empty
    text has none. Rows stay as they are, repeated or without an id; other columns are not read.
    Texts are read once; what was found is written to the shared folder.
    """
    found = stage(candidates(docs), "candidates")
    both = found.join(link(found, scope), _KEYS, "left")
    number = lambda kind: F.size(
        F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind].name}")
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPANS))))
    return both.select(
        "doc_id", number(0), number(1), number(2),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(every).alias("spans"))


#: Characters of the pieces that stretches of a text are put together from.
PIECE = 64
_STRETCHES = "array<struct<start:int,end:int>>"


def _masked(text: Column, spans: Column) -> Column:
    """The text with a mask in place of every stretch that spans cover, which are sorted.

    What stays between masks is put together from the pieces that it touches: to look for a place
    in the text itself would begin at its first character each time.
    """
    def emit(at: Column, span: Column) -> tuple[Column, Column]:
        apart = (span["start"] >= at) & (span["end"] > at)
        stretch = F.array(F.struct(at.alias("start"), span["start"].alias("end")))
        return (F.greatest(at, span["end"]),
                F.when(apart, stretch).otherwise(F.array().cast(_STRETCHES)))

    stays = _let(_folded(spans, _STRETCHES, emit), lambda walk: F.concat(
        walk["found"], F.array(F.struct(
            walk["at"].alias("start"), F.length(text).alias("end")))))

    def between(pieces: Column, stretch: Column) -> Column:
        first = F.floor(stretch["start"] / PIECE).cast("int")
        last = F.ceil(stretch["end"] / PIECE).cast("int")
        near = F.array_join(_some(pieces, first, last), "")
        cut = F.substring(near, stretch["start"] % PIECE + 1, stretch["end"] - stretch["start"])
        return F.when(stretch["end"] > stretch["start"], cut).otherwise("")

    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(.{{1,{PIECE}}})"))
    return F.array_join(_let(pieces, lambda every: F.transform(
        stays, lambda stretch: between(every, stretch))), MASK)


def mask_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """All rows of docs with their columns, every reported span replaced by a mask.

    Where a text changes, n_chars, if there is such a column, becomes its new length. Texts that
    hold nothing stay as they are, null ones too. Other columns stay, whatever their names.
    """
    found = stage(candidates(docs), "candidates")
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPANS))))
    hit = (
        found.dropDuplicates(_KEYS).join(link(found, scope), _KEYS, "left")
        .select(*_KEYS, every.alias("spans")).filter(F.size("spans") > 0)
    )
    met = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in _keys().items()]).join(
        hit, _KEYS, "left")
    row = F.col("row")
    changed = F.col("spans").isNotNull()
    text = F.when(changed, _masked(row.getField("text"), F.col("spans"))).otherwise(
        row.getField("text"))

    def column(name: str) -> Column:
        held = row.getField(name)
        if name == "n_chars":
            length = F.length("masked").cast(docs.schema[name].dataType)
            held = F.when(changed, length).otherwise(held)
        return (F.col("masked") if name == "text" else held).alias(name)

    return met.withColumn("masked", text).select(*[column(name) for name in docs.columns])
