"""The trie of conversation prefixes against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from barkeep.llm import trie
from barkeep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def ordered(rows):
    """Turns (role, text) of each conversation."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            found[conv_id].append(((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest()), role, text))
    return {c: [t[1:] for t in sorted(turns)] for c, turns in found.items()}


def by_hand(paths):
    members, below = defaultdict(list), defaultdict(set)
    for conv_id, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv_id)
            if d:
                below[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved, found = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        kids, n = below[node], len(members[node])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = sum(saved[k] for k in kids) + ((n - 1) * len(node[-1][1].encode()) if node else 0)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else -1
        found.append(
            (min(members[node]), len(node), parent, n, len(kids), leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found)


def listed(nodes):
    return sorted(tuple(-1 if x is None else x for x in r) for r in nodes.collect())


def with_digests(nodes, ends):
    return nodes.join(trie.end_digests(ends), ["n1", "n2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)),
    )


def test_query_against_a_trie_by_hand(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    logged = ordered(rows)
    paths = {}
    for c, own in logged.items():
        head = zlib.crc32(str(c).encode()) % 9
        paths[c] = logged.get(c - c % 5, [])[:head] + own[head:]
    assert listed(QUERIES["op12_conversation_trie"](spark, SF)) == by_hand(paths)


def test_long_conversations_nulls_ties_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 3)
    monkeypatch.setattr(trie, "RANGE", 4)
    rnd = random.Random(2)
    long = [("user", f"turn {i} é") for i in range(150)]
    rows = []
    for c in range(40):
        size = rnd.choice([1, 7, 8, 9, 16, 17, 60, 150])
        turns = long[:size] if c % 3 else long[: size // 2] + [("bot", str(rnd.randrange(3)))] * 3
        rows += [(c, i, *turn) for i, turn in enumerate(turns)]
    rows += [(100, None, None, None), (100, None, "a", "x"), (100, 1, "a", "x"), (100, 1, "a", "x"), (100, 1, "b", "")]
    rows += [(None, 1, "a", "x"), (-7, 5, "user", "turn 0 é"), (101, 2**40, None, "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = with_digests(*trie.conversation_trie(frame.selectExpr("*", "1 as place", "2 as block", "3 as n1", "4 as a")))
    assert listed(got) == by_hand(ordered(rows))


def test_one_conversation_with_most_rows_and_many_copies(spark):
    rows = [(1, i, "user", f"t{i % 50}") for i in range(3_000)] + [(c, 0, "user", "same") for c in range(2, 1_500)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    nodes, ends = trie.conversation_trie(frame)
    assert nodes.count() == 3_002 and ends.count() == 1_499
    assert listed(with_digests(nodes, ends)) == by_hand(ordered(rows))


def test_members_without_turns_and_no_conversations(spark):
    turns = spark.createDataFrame([(5, 1, 11, 12, 3)], "conv_id long, place long, a long, b long, bytes long")
    members = spark.createDataFrame([(5,), (4,)], "conv_id long")
    nodes, ends = trie.prefix_trie(turns, members)
    assert listed(nodes.drop("n1", "n2")) == [(4, 0, -1, 2, 1, 1, 0), (5, 1, 4, 1, 0, 1, 0)]
    nodes, ends = trie.conversation_trie(
        spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    )
    assert nodes.count() == 0 and ends.count() == 0
