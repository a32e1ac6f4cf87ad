"""The conversation trie against a plain restatement, and the radix tree's layouts."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from gondola.llm import prefix_trie
from gondola.llm.prefix_trie import (COLUMNS, UNBOUNDED, Direct, Few, Indexed, RadixTree,
                                     block_nodes, conversation_trie)

from .rows import key

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_rebuilt(rows):
    """rows: (conv_id, turn, role, text); the turns (role, text) of every rebuilt conversation."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            same = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn, same, (role, text)))
    own = {c: [t[3] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, t[2]))]
           for c, turns in convs.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def plain_trie(convs):
    """convs: id to turns; the rows of all nodes."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].add(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children[prefix]
        leaves[prefix] = sum(leaves[b] for b in below) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        saved[prefix] = own + sum(saved[b] for b in below)
    rows = []
    for prefix, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(prefix))
        rows.append((min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own),
                     len(children[prefix]), leaves[prefix], saved[prefix],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=key)


def conversations(n, seed):
    """Few texts, so that prefixes meet; a third of the conversations are equal."""
    rng = random.Random(seed)
    texts = ["", None, "a", "b\U0001F600é", "long " * 40, "c", "d"]
    same = [(rng.choice(["user", None]), rng.choice(texts)) for _ in range(9)]
    rows = []
    for c in rng.sample(range(5 * n), n):
        for turn in range(rng.randint(1, 9)):
            role, text = same[turn] if c % 3 == 0 else (rng.choice(["user", "bot"]),
                                                       rng.choice(texts[:4]))
            rows.append((c, None if rng.random() < 0.1 else turn, role, text))
    return rows


def results(df):
    assert tuple(df.columns) == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.mark.parametrize(("n", "block"), [(1, 5), (40, 3), (400, 7), (400, 20_000)])
def test_nodes_equal_the_plain_trie(spark, monkeypatch, n, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_KEYS", block)
    rows = conversations(n, n)
    got = results(conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain_trie(plain_rebuilt(rows))


def test_awkward_conversations(spark):
    rows = [(None, 1, "user", "no conversation"), (7, None, None, None), (7, None, None, None),
            (7, 3, "user", "x"), (7, 3, "user", "x"), (7, 3, "bot", "y"), (100, 0, "user", "z"),
            (101, 0, "us", "erz"), (102, 0, "u", "serz"), (103, 2, "user", "z" * 70_000)]
    turnless = next(c for c in range(901, 999) if zlib.crc32(str(c).encode()) % 6)
    rows += [(turnless, 0, "user", "taken away")]
    rows += [(250, t, "user", f"turn {t}") for t in range(600)]
    rows += [(251, t, "user", f"turn {t}") for t in range(590)]
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["c", "key", "chars", "turns", "TURN", "part", "open", "_base", "id"]
    got = results(conversation_trie(df.selectExpr(*[f"'x' AS {n}" for n in names], *df.columns)))
    assert got == plain_trie(plain_rebuilt(rows))
    assert plain_rebuilt(rows)[turnless] == []  # a member of the root only


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversations(spark, rows):
    assert results(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == []


def test_layouts_grow_as_children_come():
    tree, kinds = RadixTree(), []
    for byte in range(256):
        tree.insert(bytes([byte, 7]), [1], [byte])
        kinds.append((type(tree.root.layout), getattr(tree.root.layout, "places", None)))
    assert [kinds.count(k) for k in ((Few, 4), (Few, 16), (Indexed, None), (Direct, None))] == [
        4, 12, 32, 208]
    for byte in range(256):
        assert tree.root.layout.find(byte).ids == [byte]
        assert tree.root.layout.find(byte).path == bytes([byte, 7])


def test_paths_are_compressed_and_split():
    tree = RadixTree()
    for at, text in enumerate([b"abcdef", b"abcxyz", b"abcdef", b"abc", b""]):
        tree.insert(text, [1], [at])
    node = tree.root.layout.find(ord("a"))
    assert (tree.root.ids, node.path, node.ids) == ([4], b"abc", [3])
    assert {c.path: c.ids for c in node.layout.children()} == {b"def": [0, 2], b"xyz": [1]}


def test_only_depths_of_whole_turns_are_nodes():
    rng = random.Random(5)
    keys = sorted(bytes(rng.choice(b"\x00\x01\xff") for _ in range(2 * rng.randint(0, 5)))
                  for _ in range(200))
    rows = block_nodes(keys, [[3] * 5] * 200, list(range(200)), -1, -1, width=2)
    want = plain_trie({i: [(k[j:j + 2], "xxx") for j in range(0, len(k), 2)]
                       for i, k in enumerate(keys)})
    got = [tuple(r.get(c) for c in COLUMNS) for r in rows]
    assert sorted(got, key=key) == want
    assert not any(r["open"] for r in rows)
    ends = block_nodes(keys, [[3] * 5] * 200, list(range(200)), UNBOUNDED, UNBOUNDED, width=2)
    assert sum(r["open"] for r in ends) <= 1 + (len(keys[0]) + len(keys[-1])) // 2
