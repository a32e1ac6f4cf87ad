"""The prefix trie of all conversations, from adaptive radix trees over blocks of sorted keys.

A turn's id is the MD5 of its role and text, sixteen big-endian bytes; a conversation's key
is the ids of its turns one after the other. The keys are sorted by Spark in ranges
of (key, conversation), so equal and alike conversations of any number are cut into
blocks of bounded size. A task puts the keys of a block into an adaptive radix tree: nodes
with 4, 16, 48 or 256 places that grow as children come, and whole runs of bytes without a
branch in one node. Only byte depths where a turn ends become nodes of the trie.

A node of the trie that lies within one block is finished there. One that may go on in the
next block is a prefix of the block's first or last key, so a block reports as many of them as
these two keys have turns at most. They are merged by key, and one pass in the order of the
keys sums up their subtrees. The SHA-256 of a list of ids runs over its pieces in order.

Turns come in order of their number, null first, equal numbers by id. A null role or text
is empty; rows without a conversation are left out; a table without any has no nodes, else
there is a root. A conversation has to fit into a row, as a text does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import pick, saved, small

#: Bytes of a turn's id.
WIDTH = 16
#: Keys and bytes of keys of a block at most.
BLOCK_KEYS, BLOCK_BYTES = 20_000, 16 << 20
#: Conversations share the first turns of the one whose id is the next lower multiple.
SHARED, HEAD_TURNS = 100, 6

UNBOUNDED = 1 << 40

PARTS = ("open boolean, conv_id bigint, depth bigint, parent_conv_id bigint, node_key binary, "
         "parent_key binary, n_convs bigint, n_children bigint, n_leaves bigint, "
         "saved_tokens bigint, ends_sha256 string, chars bigint, ids binary, part int, "
         "block bigint, place bigint")
NODES = ("node_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


class Few:
    """Up to 4 or 16 children, their bytes side by side."""

    def __init__(self, places: int):
        self.places, self.bytes, self.nodes = places, bytearray(), []

    def find(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def full(self) -> bool:
        return len(self.nodes) == self.places

    def put(self, byte: int, node: Node) -> None:
        at = self.bytes.find(byte)
        if at < 0:
            self.bytes.append(byte)
            self.nodes.append(node)
        else:
            self.nodes[at] = node

    def children(self) -> list[Node]:
        return self.nodes

    def grown(self) -> Few | Indexed:
        larger = Few(16) if self.places < 16 else Indexed()
        for byte, node in zip(self.bytes, self.nodes, strict=True):
            larger.put(byte, node)
        return larger


class Indexed:
    """Up to 48 children, found by a table of 256 places."""

    def __init__(self):
        self.index, self.nodes = bytearray(256), []

    def find(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def full(self) -> bool:
        return len(self.nodes) == 48

    def put(self, byte: int, node: Node) -> None:
        if self.index[byte]:
            self.nodes[self.index[byte] - 1] = node
        else:
            self.nodes.append(node)
            self.index[byte] = len(self.nodes)

    def children(self) -> list[Node]:
        return self.nodes

    def grown(self) -> Direct:
        larger = Direct()
        for byte, at in enumerate(self.index):
            if at:
                larger.put(byte, self.nodes[at - 1])
        return larger


class Direct:
    """A place for each byte."""

    def __init__(self):
        self.nodes = [None] * 256

    def find(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, node: Node) -> None:
        self.nodes[byte] = node

    def children(self) -> list[Node]:
        return [n for n in self.nodes if n is not None]


class Node:
    """The end of a run of bytes without a branch; ``chars`` are lengths along any key below."""

    __slots__ = ("path", "layout", "ids", "chars", "n", "least", "tops", "leaves", "saved",
                 "first", "last")

    def __init__(self, path: bytes, chars: list[int]):
        self.path, self.chars, self.layout, self.ids = path, chars, Few(4), []
        self.n, self.least, self.tops, self.leaves, self.saved = 0, None, [], 0, 0
        self.first = self.last = False


def shared(a: bytes, b: bytes) -> int:
    """Bytes that both begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y)


class RadixTree:
    """An adaptive radix tree; a key's ids stand at the node where it ends."""

    def __init__(self):
        self.root = Node(b"", [])

    def insert(self, key: bytes, chars: list[int], ids: list[int]) -> Node:
        node, at = self.root, 0
        while at < len(key):
            child = node.layout.find(key[at])
            if child is None:
                child = Node(key[at:], chars)
                if node.layout.full():
                    node.layout = node.layout.grown()
                node.layout.put(key[at], child)
            elif not key.startswith(child.path, at):
                same = shared(child.path, key[at:at + len(child.path)])
                middle = Node(child.path[:same], chars)
                child.path = child.path[same:]
                middle.layout.put(child.path[0], child)
                node.layout.put(key[at], middle)
                child = middle
            node, at = child, at + len(child.path)
        node.ids += ids
        return node

    def bottom_up(self) -> Iterator[tuple[Node, int, Node | None]]:
        """Every node with its byte depth and parent, children before parents."""
        order, stack = [], [(self.root, 0, None)]
        while stack:
            order.append(entry := stack.pop())
            node, depth, _ = entry
            stack += [(c, depth + len(c.path), node) for c in node.layout.children()]
        return reversed(order)


def joined(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def prefix_keys(key: bytes, width: int) -> list[bytes]:
    """A digest for every prefix of whole turns."""
    digest, out = hashlib.sha256(), []
    for at in range(0, len(key) + 1, width):
        out.append(digest.digest())
        digest.update(key[at:at + width])
    return out


def block_nodes(keys: list[bytes], chars: list[list[int]], ids: list[int], left: int, right: int,
                width: int = WIDTH) -> list[dict]:
    """The trie's nodes of sorted keys, those that neighbours may share marked ``open``.

    ``left`` and ``right``: depths to which the first and the last key may go on outside. An
    open node has counts of what is finished below it; its own share comes later.
    """
    tree, at = RadixTree(), 0
    while at < len(keys):
        end = at + 1
        while end < len(keys) and keys[end] == keys[at]:
            end += 1
        node = tree.insert(keys[at], chars[at], ids[at:end])
        node.first |= at == 0
        node.last |= end == len(keys)
        at = end
    from_first, from_last = prefix_keys(keys[0], width), prefix_keys(keys[-1], width)
    rows = []
    for node, end, parent in tree.bottom_up():
        own, begin = node.ids, end - len(node.path)
        if own:
            node.n += len(own)
            node.least = min(own) if node.least is None else min(node.least, *own)
        at = end - end % width
        while at > begin or at == 0 and parent is None:
            depth, ends = at // width, own if at == end else []
            count = node.chars[depth - 1] if depth else 0
            is_open = node.first and depth <= left or node.last and depth <= right
            row = {"open": is_open, "conv_id": node.least, "depth": depth, "n_convs": node.n,
                   "n_children": len(node.tops), "chars": count}
            if is_open:
                on = from_first if node.first else from_last
                for child in node.tops:
                    child["parent_key"] = on[depth]
                row |= {"node_key": on[depth], "parent_key": on[depth - 1] if depth else None,
                        "n_leaves": node.leaves, "saved_tokens": node.saved,
                        "ids": joined(ends) if ends else None,
                        "place": depth if node.first else UNBOUNDED + depth}
                node.tops, node.leaves, node.saved = [], 0, 0
            else:
                for child in node.tops:
                    child["parent_conv_id"] = node.least
                node.leaves = node.leaves or 1
                node.saved += (node.n - 1) * count
                row |= {"n_leaves": node.leaves, "saved_tokens": node.saved,
                        "ends_sha256": hashlib.sha256(joined(ends)).hexdigest()}
                node.tops = [row]
            rows.append(row)
            at -= width
        if parent is not None:
            parent.n += node.n
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
            parent.tops += node.tops
            parent.leaves += node.leaves
            parent.saved += node.saved
            parent.first |= node.first
            parent.last |= node.last
    return rows


def _columns(rows: list[dict], ddl: str) -> pa.RecordBatch:
    kinds = {"boolean": pa.bool_(), "bigint": pa.int64(), "int": pa.int32(),
             "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_pydict({
        name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields})


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted keys of a partition, block by block."""
    part, block, left = TaskContext.get().partitionId(), 0, UNBOUNDED
    keys, chars, ids, held = [], [], [], 0

    def nodes(right: int) -> pa.RecordBatch:
        rows = block_nodes(keys, chars, ids, left, right)
        return _columns([r | {"part": part, "block": block} for r in rows], PARTS)

    for batch in batches:
        for row in batch.to_pylist():
            if len(keys) == BLOCK_KEYS or held > BLOCK_BYTES:
                turns = shared(keys[-1], row["key"]) // WIDTH
                yield nodes(turns)
                keys, chars, ids, held = [], [], [], 0
                block, left = block + 1, turns
            keys.append(row["key"])
            chars.append(row["chars"])
            ids.append(row["c"])
            held += len(row["key"])
    if keys:
        yield nodes(UNBOUNDED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of every node's list, which come in order."""
    key, digest = None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["node_key"] == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append({"node_key": key, "sha": digest.hexdigest()})
                key, digest = row["node_key"], hashlib.sha256()
            digest.update(row["ids"])
        yield _columns(out, "node_key binary, sha string")
    if key is not None:
        yield _columns([{"node_key": key, "sha": digest.hexdigest()}],
                       "node_key binary, sha string")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged open nodes, parents before children, with their subtrees summed up."""
    path: list[dict] = []

    def closed() -> dict:
        node = path.pop()
        node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["chars"]
        if path:
            path[-1]["n_children"] += 1
            path[-1]["n_leaves"] += node["n_leaves"]
            path[-1]["saved_tokens"] += node["saved_tokens"]
        return node

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            while path and path[-1]["depth"] >= row["depth"]:
                out.append(closed())
            path.append(row | {"parent_conv_id": path[-1]["conv_id"] if path else None})
        yield _columns(out, NODES)
    yield _columns([closed() for _ in range(len(path))], NODES)


def _turns(df: DataFrame) -> DataFrame:
    """``c, turns``: the ordered turns of every conversation as (number, id, characters)."""
    rows = pick(df, c="conv_id", turn="turn", role="role", text="text").filter("c IS NOT NULL")
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    turn = F.struct(F.col("turn"), F.md5(F.concat(
        F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        F.char_length(text).alias("chars"))
    return rows.select(F.col("c").cast("bigint").alias("c"), turn.alias("turn")).groupBy("c").agg(
        F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt_keys(df: DataFrame) -> DataFrame:
    """``c, key, chars`` of every conversation, its first turns taken from its group's first."""
    convs = saved(_turns(df))
    heads = convs.filter(F.col("c") % SHARED == 0).select(
        F.col("c").alias("_base"), F.slice("turns", 1, HEAD_TURNS - 1).alias("_head"))
    n = (F.crc32(F.col("c").cast("string")) % HEAD_TURNS).cast("int")
    own = F.slice("turns", n + 1, F.greatest(F.size("turns") - n, F.lit(0)))
    head = F.when(F.col("_head").isNull(), F.slice("turns", 1, F.lit(0))).otherwise(
        F.slice("_head", F.lit(1), n))
    rows = convs.withColumn("_base", F.col("c") - F.col("c") % SHARED).join(
        heads, "_base", "left").select("c", F.concat(head, own).alias("turns"))
    ids = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    return rows.select("c", F.unhex(ids).alias("key"),
                       F.transform("turns", lambda t: t["chars"]).alias("chars"))


def trie_of_keys(keyed: DataFrame) -> DataFrame:
    """Nodes of the trie over ``c, key, chars``: keys of whole turns, lengths of the turns."""
    keyed = saved(keyed)
    parts = saved(keyed.repartitionByRange("key", "c").sortWithinPartitions("key", "c")
                  .mapInArrow(_trees, PARTS))
    shared_nodes = parts.filter("open")
    place = F.struct("part", "block", "place")
    merged = shared_nodes.groupBy("node_key").agg(
        F.min(place).alias("place"), F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    digests = (shared_nodes.filter("ids IS NOT NULL").select("node_key", "part", "block", "ids")
               .repartition("node_key").sortWithinPartitions("node_key", "part", "block")
               .mapInArrow(_digests, "node_key binary, sha string"))
    nothing = hashlib.sha256().hexdigest()
    listed = merged.join(digests, "node_key", "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(nothing))).drop("sha")
    top = saved(listed.repartition(1).sortWithinPartitions("place").drop("place")
                .mapInArrow(_summed, NODES))
    inner = parts.filter("NOT open")
    parents = small(top.select(F.col("node_key").alias("parent_key"),
                               F.col("conv_id").alias("_parent")))
    below = inner.filter("parent_key IS NOT NULL").join(parents, "parent_key").withColumn(
        "parent_conv_id", F.col("_parent"))
    return (inner.filter("parent_key IS NULL").select(*COLUMNS)
            .unionByName(below.select(*COLUMNS)).unionByName(top.select(*COLUMNS)))


def conversation_trie(df: DataFrame) -> DataFrame:
    """A row for every distinct sequence of first turns of the rebuilt conversations.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens`` (characters that a stored prefix saves in the subtree), ``ends_sha256``
    (of the members that end here).
    """
    return trie_of_keys(rebuilt_keys(df))


ORACLE = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
convs AS (
  SELECT c, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''),
                                              lambda s: ascii(s)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL), crc),
turns AS (
  SELECT c, id, chars, row_number() OVER (
    PARTITION BY c ORDER BY turn NULLS FIRST, id, chars) AS pos
  FROM (SELECT conv_id AS c, turn, length(coalesce(text, '')) AS chars,
               md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '')
                   || coalesce(text, '')) AS id
        FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT v.c, t.pos AS d, t.id, t.chars
  FROM convs v JOIN turns t ON t.c = v.c - v.c % 100 AND t.pos <= v.h),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT v.c, t.pos - v.h + coalesce(n, 0), t.id, t.chars
  FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h
  LEFT JOIN (SELECT c, COUNT(*) AS n FROM heads GROUP BY c) b ON b.c = v.c),
keyed AS (
  SELECT v.c, coalesce(ids, []) AS ids, coalesce(chars, []) AS chars FROM convs v LEFT JOIN (
    SELECT c, list(id ORDER BY d) AS ids, list(chars ORDER BY d) AS chars
    FROM rebuilt GROUP BY c) r ON r.c = v.c),
steps AS (SELECT c, ids, chars, unnest(range(len(ids) + 1)) AS d FROM keyed),
nodes AS (
  SELECT d, array_to_string(ids[1:d], '') AS k, MIN(c) AS conv_id, COUNT(*) AS n_convs,
         (COUNT(*) - 1) * coalesce(MAX(chars[d]), 0) AS own,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len(ids)), ''))
           AS ends_sha256
  FROM steps GROUP BY d, array_to_string(ids[1:d], '')),
children AS (
  SELECT left(k, 32 * (d - 1)) AS k, d - 1 AS d, COUNT(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children
  FROM nodes LEFT JOIN children ON children.d = nodes.d AND children.k = nodes.k),
below AS (
  SELECT a AS d, left(k, 32 * a) AS k, SUM(own) AS saved, SUM((n_children = 0)::INT) AS leaves
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM counted) GROUP BY ALL)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, x.ends_sha256
FROM counted x JOIN below b ON b.d = x.d AND b.k = x.k
LEFT JOIN counted p ON p.d = x.d - 1 AND p.k = left(x.k, 32 * (x.d - 1))
"""
