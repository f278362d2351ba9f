"""The prefix trie of conversations: who shares which first turns, and what sharing saves.

Turns are encoded by a dictionary of their texts, so a conversation is a list of numbers. The lists are
sorted into range shards, and a task reads its shard in blocks of bounded size. Each block becomes a
ternary search tree, balanced by inserting the median first, and is walked without recursion.

Nodes off the first and the last path of a block are complete there. Those on the paths may go on in
the blocks beside it, so they stay open with what is known of them. Neighbours are merged, blocks inside
their task and shards in rounds of 64: what is on neither outer path is complete and closes, deepest
first. A round moves two paths per shard, whatever the shards hold.
"""

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pitlane.llm.common import stage
from pitlane.operators.joins import attach_small
from pitlane.sources.tables import stack

#: Conversations that share a head, and the heads' lengths: 0 to HEADS - 1 turns.
GROUP, HEADS = 20, 4
#: Turns after which a block ends; a conversation counts as one more.
BLOCK_TURNS = 200_000
#: Numbers that travel as one piece of a list of conversations.
PIECE = 8192
#: Shards that one merge takes.
FAN = 64
#: A turn that more rows than a share of all repeat is looked up by a broadcast.
HOT_SHARE = 100_000

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256"]
_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    *[T.StructField(c, T.StringType() if c == "ends_sha256" else T.LongType()) for c in NODE],
    T.StructField("key", T.BinaryType()), T.StructField("parent_key", T.BinaryType()),
    T.StructField("words", T.LongType()),
    T.StructField("first", T.BooleanType()), T.StructField("last", T.BooleanType()),
    T.StructField("part", T.LongType()), T.StructField("place", T.LongType()),
    T.StructField("ids", T.StringType()),
])
_NAMES = _SCHEMA.names
_ROOT = b""


# --- sequences ----------------------------------------------------------------------------------

def _encoded(turns: DataFrame) -> DataFrame:
    """conv_id, turn, digest, words and the number of each turn in the dictionary.

    The dictionary has about as many rows as there are turns. What very many rows repeat is in a list
    that its definition bounds, and is broadcast; the rest meets the dictionary by its digest.
    """
    # Written once with their numbers, so that these stay as they are.
    dictionary = stage(
        turns.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("id", F.monotonically_increasing_id()), "dictionary")
    often = F.col("rows") > turns.count() // HOT_SHARE + 1000
    hot = dictionary.filter(often).select("digest", F.col("id").alias("hot"))
    met = turns.join(F.broadcast(hot), "digest", "left")
    columns = [*turns.columns, "id"]
    common = met.filter("hot IS NOT NULL").withColumnRenamed("hot", "id").select(*columns)
    rest = met.filter("hot IS NULL").drop("hot")
    return common.unionByName(
        rest.join(dictionary.filter(~often).select("digest", "id"), "digest").select(*columns))


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, ids and words: the own turns of each conversation in their order.

    Turns are ordered by turn, none first, equal ones by a digest of role and text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = stage(conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
        .alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).alias("words")), "turns")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "id", "words")))
    return _encoded(turns).groupBy("conv_id").agg(ordered.alias("t")).select(
        "conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))


def head_length(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first one of its group."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation with the head of its group's first one in place of its own first turns."""
    first = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"),
        *[F.slice(c, 1, HEADS - 1).alias(f"head_{c}") for c in ("ids", "words")])
    based = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(
        first, "base", "left")
    length = head_length(F.col("conv_id"))

    def spliced(column: str) -> Column:
        none = F.array().cast(own.schema[column].dataType)
        rest = F.slice(column, length + 1, F.greatest(F.size(column) - length, F.lit(0)))
        # A slice of length 0 is empty.
        return F.concat(F.slice(F.coalesce(f"head_{column}", none), F.lit(1), length), rest)

    return based.select("conv_id", *[spliced(c).alias(c) for c in ("ids", "words")])


# --- one block ----------------------------------------------------------------------------------

class TernaryTree:
    """Sequences of numbers; node 0 is the empty sequence. A node's children are a search tree.

    `low` and `high` lead to siblings with smaller and larger turns, `equal` to the next turn.
    """

    def __init__(self):
        self.turn, self.low, self.equal, self.high = [-1], [0], [0], [0]
        self.words = [0]

    def _new(self, turn: int, words: int) -> int:
        self.turn.append(turn)
        self.words.append(words)
        for links in (self.low, self.equal, self.high):
            links.append(0)
        return len(self.turn) - 1

    def insert(self, turns: list[int], words: list[int]) -> int:
        """The node of a sequence, made with all before it where it is new."""
        at = 0
        for turn, n in zip(turns, words):
            links, here = self.equal, at
            while links[here] and self.turn[links[here]] != turn:
                here = links[here]
                links = self.low if turn < self.turn[here] else self.high
            if not links[here]:
                links[here] = self._new(turn, n)
            at = links[here]
        return at

    def path(self, turns: list[int]) -> list[int]:
        """The nodes of a sequence that is in the tree, the root first."""
        nodes = [0]
        for turn in turns:
            here = self.equal[nodes[-1]]
            while self.turn[here] != turn:
                here = (self.low if turn < self.turn[here] else self.high)[here]
            nodes.append(here)
        return nodes

    def walk(self) -> Iterator[tuple[int, int]]:
        """(node, its parent), every parent before its children, the root left out."""
        waiting = [(self.equal[0], 0)]
        while waiting:
            node, parent = waiting.pop()
            if node:
                yield node, parent
                waiting += [(self.low[node], parent), (self.high[node], parent),
                            (self.equal[node], node)]


def median_first(count: int) -> Iterator[int]:
    """0 to count - 1: the middle, then the middles of both sides, and so on."""
    waiting = [(0, count)]
    while waiting:
        begin, end = waiting.pop()
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            waiting += [(begin, middle), (middle + 1, end)]


def _hash(texts: Iterable[str]) -> str:
    digest = hashlib.sha256()
    for text in texts:
        digest.update(text.encode())
    return digest.hexdigest()


def _keys(turns: list[int]) -> list[bytes]:
    """What names the nodes of a path in every shard."""
    keys = [_ROOT]
    for turn in turns:
        keys.append(hashlib.sha256(keys[-1] + turn.to_bytes(8, "little")).digest())
    return keys


def _row(kind: str, **values) -> dict:
    return {"kind": kind, **values}


@dataclass
class _Open:
    """Nodes that may go on in a neighbour, by key, with what is complete below them."""

    nodes: dict[bytes, dict]


def _block(rows: list[tuple[int, list[int], list[int]]], part: int, place: int) -> tuple[_Open, list]:
    """The open nodes of a block of sorted (conv_id, ids, words), and rows of all that is complete."""
    groups = []  # (begin, end) of rows with one sequence
    for n, (_, turns, _) in enumerate(rows):
        if n and turns == rows[groups[-1][0]][1]:
            groups[-1][1] = n + 1
        else:
            groups.append([n, n + 1])
    tree, ends = TernaryTree(), {}
    for n in median_first(len(groups)):
        begin, end = groups[n]
        ends[tree.insert(rows[begin][1], rows[begin][2])] = (begin, end)

    size = len(tree.turn)
    parent, depth = [0] * size, [0] * size
    least, convs = [None] * size, [0] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for node, (begin, end) in ends.items():
        least[node], convs[node] = rows[begin][0], end - begin
    order = list(tree.walk())
    for node, above in order:
        parent[node], depth[node] = above, depth[above] + 1

    keys = {}
    paths = []
    for turns in (rows[0][1], rows[-1][1]):
        nodes = tree.path(turns)
        paths.append(set(nodes))
        keys |= dict(zip(nodes, _keys(turns)))

    for node, above in reversed(order):
        least[above] = min(v for v in (least[above], least[node]) if v is not None)
        convs[above] += convs[node]
        if node in keys:
            continue  # counted below its parent when it closes
        leaves[node] = leaves[node] or 1
        saved[node] += (convs[node] - 1) * tree.words[node]
        children[above] += 1
        leaves[above] += leaves[node]
        saved[above] += saved[node]

    def listed(node: int) -> Iterator[str]:
        begin, end = ends.get(node, (0, 0))
        for n in range(begin, end, PIECE):
            yield ("," if n > begin else "") + ",".join(
                str(row[0]) for row in rows[n:min(n + PIECE, end)])

    done, nodes = [], {}
    for node in [0, *[n for n, _ in order]]:
        above = parent[node]
        counts = dict(conv_id=least[node], depth=depth[node], n_convs=convs[node],
                      n_children=children[node], n_leaves=leaves[node], saved_tokens=saved[node])
        if node not in keys:
            place_above = ({"parent_key": keys[above]} if above in keys
                           else {"parent_conv_id": least[above]})
            done.append(_row("node" if above not in keys else "child", **counts, **place_above,
                             ends_sha256=_hash(listed(node))))
            continue
        nodes[keys[node]] = _row(
            "open", **counts, key=keys[node], parent_key=keys[above] if node else None,
            words=tree.words[node], first=node in paths[0], last=node in paths[1])
        begin, end = ends.get(node, (0, 0))
        done += [_row("piece", key=keys[node], part=part, place=place + n, ids=",".join(
            str(row[0]) for row in rows[n:min(n + PIECE, end)])) for n in range(begin, end, PIECE)]
    return _Open(nodes), done


# --- merging ------------------------------------------------------------------------------------

def _merge(left: _Open, right: _Open) -> tuple[_Open, list]:
    """Two neighbours as one, and the nodes that close as they are on neither outer path."""
    nodes = {}
    for node in [*left.nodes.values(), *right.nodes.values()]:
        same = nodes.get(node["key"])
        if same is None:
            nodes[node["key"]] = dict(node)
        else:
            same["conv_id"] = min(same["conv_id"], node["conv_id"])
            for name in _COUNTS:
                same[name] += node[name]
    for key, node in nodes.items():
        node["first"] = key in left.nodes and left.nodes[key]["first"]
        node["last"] = key in right.nodes and right.nodes[key]["last"]
    closing = [key for key, node in nodes.items() if not (node["first"] or node["last"])]
    return _closed(nodes, closing)


def _closed(nodes: dict[bytes, dict], closing: list[bytes]) -> tuple[_Open, list]:
    """Complete the nodes named, the deepest first, and add them to those above."""
    done = []
    for key in sorted(closing, key=lambda k: -nodes[k]["depth"]):
        node = nodes.pop(key)
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
        above = nodes.get(node["parent_key"])
        if above is not None:
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved_tokens"] += node["saved_tokens"]
        done.append(node | {"kind": "shared"})
    return _Open(nodes), done


def _batch(rows: list[dict], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row.get(f.name) for row in rows], f.type) for f in arrow], schema=arrow)


def _shards(ordered: DataFrame, block_turns: int) -> DataFrame:
    """Complete nodes, open nodes and pieces of every range shard."""
    arrow = to_arrow_schema(_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, turns, place, merged = [], 0, 0, None

        def finished() -> list[dict]:
            nonlocal held, turns, place, merged
            opened, done = _block(held, part, place)
            place += len(held)
            held, turns = [], 0
            if merged is not None:
                opened, closed = _merge(merged, opened)
                done += closed
            merged = opened
            return done

        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "ids", "words")]
            for n in range(batch.num_rows):
                row = tuple(column[n].as_py() for column in columns)
                held.append(row)
                turns += len(row[1]) + 1
                if turns >= block_turns:
                    yield _batch(finished(), arrow)
        if held:
            yield _batch(finished(), arrow)
        if merged is not None:
            yield _batch([node | {"part": part} for node in merged.nodes.values()], arrow)

    return ordered.select("conv_id", "ids", "words").mapInArrow(run, _SCHEMA)


def _round(opened: DataFrame, last: bool, fan: int) -> DataFrame:
    """Merge up to `fan` neighbouring shards; in the last round everything closes."""
    def run(table: pa.Table) -> pa.Table:
        shards: dict[int, dict[bytes, dict]] = {}
        for row in table.to_pylist():
            shards.setdefault(row["part"], {})[row["key"]] = row
        merged, done = None, []
        for part in sorted(shards):
            if merged is None:
                merged = _Open(shards[part])
            else:
                merged, closed = _merge(merged, _Open(shards[part]))
                done += closed
        if last:
            merged, closed = _closed(merged.nodes, list(merged.nodes))
            done += closed
        part = min(shards) // fan
        done += [node | {"kind": "open", "part": part} for node in merged.nodes.values()]
        return pa.Table.from_batches([_batch(done, table.schema)])

    group = F.floor(F.col("part") / fan) if not last else F.lit(0)
    return opened.select(*_NAMES).groupBy(group.alias("group")).applyInArrow(run, _SCHEMA)


def _hashes(pieces: DataFrame) -> DataFrame:
    """key and the hash of its conversations, listed in the order of their pieces.

    A hash is made in one stream by its nature: a task passes over the pieces of a key and keeps
    nothing but the state.
    """
    schema = T.StructType([_SCHEMA["key"], _SCHEMA["ends_sha256"]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = digest = None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("key"), batch.column("ids")):
                text = ids.as_py().encode()
                if name.as_py() == key:
                    digest.update(b"," + text)
                    continue
                if digest is not None:
                    done.append({"key": key, "ends_sha256": digest.hexdigest()})
                key, digest = name.as_py(), hashlib.sha256(text)
            yield _batch(done, arrow)
        if digest is not None:
            yield _batch([{"key": key, "ends_sha256": digest.hexdigest()}], arrow)

    dealt = pieces.select("key", "part", "place", "ids").repartition("key")
    return dealt.sortWithinPartitions("key", "part", "place").mapInArrow(run, schema)


def trie(rows: DataFrame, block_turns: int = BLOCK_TURNS, fan: int = FAN) -> DataFrame:
    """The nodes of the trie of (conv_id, ids, words), ids being numbered turns; see `NODE`."""
    kept = stage(rows, "sequences")
    ordered = kept.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    shards = stage(_shards(ordered, block_turns), "shards")
    opened = shards.filter("kind = 'open'")
    shared = []
    parts = (opened.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        merged = stage(_round(opened, parts <= fan, fan), "merged")
        shared.append(merged.filter("kind = 'shared'"))
        if parts <= fan:
            break
        opened = merged.filter("kind = 'open'")
        parts = -(-parts // fan)
    # Blocks that were merged inside a task closed some already.
    closed = stack([shards.filter("kind = 'shared'"), *shared])
    named = closed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    counts = [c for c in NODE if c not in ("parent_conv_id", "ends_sha256")]

    def with_parent(nodes: DataFrame) -> DataFrame:
        return attach_small(nodes, named, ["parent_key"], "left").withColumn("parent_conv_id",
                                                                             F.col("above"))

    paths = with_parent(closed.select(*counts, "key", "parent_key")).join(
        _hashes(shards.filter("kind = 'piece'")), "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_hash([]))))
    children = with_parent(shards.filter("kind = 'child'").select(*counts, "ends_sha256", "parent_key"))
    whole = shards.filter("kind = 'node'")
    return stack([df.select(*NODE) for df in (whole, children, paths)])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations; see `NODE`.

    conv_id is the smallest member, parent_conv_id the parent's (the root has none), ends_sha256 the
    hash of the members that end here, in ascending order. Null roles and texts count as empty.
    Turns go by their number, none first; equal numbers by a digest of role and text, so repeated
    rows stay as turns of their own. Rows without conv_id take no part. An empty table has no
    nodes, and every other table a root. Other columns are not read.

    A conversation is one row of numbers, 12 bytes a turn, so the longest has to fit into a task.
    """
    return trie(rebuilt(stage(sequences(conversations), "own")))
