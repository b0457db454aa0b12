"""The trie of conversation prefixes."""

import hashlib
import random
import zlib

import pytest

from evidentia.llm import prefix_trie as pt
from evidentia.llm.common import read

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, path string, shard int, owner int, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, "d") for r in rows], SCHEMA)


def brute(rows, shared=True):
    """Rows (conv_id, turn, role, text) -> the nodes, by whole prefixes."""
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append(((t is not None, t or 0, d), (role, text)))
    convs = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        base = c - int(c - 100 * int(c / 100))
        paths[c] = tuple(convs.get(base, [])[:h] + convs[c][h:])
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = leaves[k] or 1
        saved[k] += (len(nodes[k]) - 1) * (len(k[-1][1]) if k else 0)
        if k:
            up = k[:-1]
            children[up], leaves[up], saved[up] = children[up] + 1, leaves[up] + leaves[k], saved[up] + saved[k]
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes_of(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards", [40])
def test_given_conversations(spark, shards):
    conversations = read(spark, SF, "conversations")
    got = nodes_of(pt.prefix_trie(pt.with_shared_start(pt.turn_lists(conversations)), shards))
    assert got == brute([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("shards", [2, 60])
def test_copies_ties_nulls_and_long_texts(spark, shards):
    rng = random.Random(shards)
    rows = [(None, 0, "user", "left out"), (900, None, None, None), (900, 1, "user", "first"), (900, 1, "user", "first"), (900, 1, "user", "tie"),
            (7, 0, "user", "x" * 200_000), (8, 0, "user", "x" * 200_000), (8, 1, "", "é😀"), (-250, 3, "user", "below nought"), (-200, 1, "user", "base")]
    for c in range(1000, 1120):  # a third of all conversations are equal, others leave them at some depth
        n = 6 if c % 3 == 0 else rng.randrange(1, 9)
        rows += [(c, t, "user" if t % 2 else "assistant", "same" if c % 3 == 0 or t < n - 1 else rng.choice("abc")) for t in range(n)]
    for shared in (True, False):
        lists = pt.turn_lists(frame(spark, rows))
        got = nodes_of(pt.prefix_trie(pt.with_shared_start(lists) if shared else lists, shards))
        assert got == brute(rows, shared)


def test_long_conversations_and_chunks_of_ends(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(12) for t in range(150 if c % 4 else 149)]
    got = nodes_of(pt.prefix_trie(pt.turn_lists(frame(spark, rows)), 5, chunk=2))
    assert got == brute(rows, False)


def test_no_conversations(spark):
    empty = frame(spark, [])
    assert nodes_of(pt.prefix_trie(pt.with_shared_start(pt.turn_lists(empty)))) == []
    only_null = frame(spark, [(None, 1, "user", "a")])
    assert nodes_of(pt.prefix_trie(pt.turn_lists(only_null))) == []


def test_turnless_rebuilt_conversation(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2)  # its base is absent
    rows = [(c, 0, "user", "gone"), (c, 1, "user", "gone too")]
    assert nodes_of(pt.prefix_trie(pt.with_shared_start(pt.turn_lists(frame(spark, rows))))) == brute(rows)
