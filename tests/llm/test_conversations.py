"""The prefix trie of conversations against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import conversations as trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, block int, t1 string, n_convs int, saved int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
CLASHING = ("x", 1, 2, "y", 3, 4)


def id_of(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def ordered(rows: list[tuple]) -> dict[int, list[tuple]]:
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, id_of(role, text), (role, text)))
    return {c: [x[3] for x in sorted(found)] for c, found in turns.items()}


def rebuilt(turns: dict[int, list[tuple]]) -> dict[int, list[tuple]]:
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def expected(turns: dict[int, list[tuple]]) -> list[tuple]:
    members = defaultdict(list)
    for c, found in turns.items():
        for d in range(len(found) + 1):
            members[tuple(found[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, found in members.items():
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(found) - 1) * words
            leaves[node[:d]] += children[node] == 0
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(turns[c]) == len(node))
        out.append((min(found), len(node), min(members[node[:-1]]) if node else None, len(found), children[node], leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def odd_rows() -> list[tuple]:
    rng = random.Random(3)
    said = [("user", "hi there"), ("assistant", "hi  there\tyou"), (None, "no role"), ("user", None), ("", ""), ("user", "x " * 500)]
    rows = []
    long = [("user", f"turn {i} of many") for i in range(43)]
    for conv in [*range(0, 70), 100, 101, 119, 141, 163, -3, -20, -23, 10**12]:
        rows += [(conv, i, *rng.choice(said)) for i in range(rng.randint(1, 5))]
    for conv in range(200, 260):  # copies, beyond several blocks, of lengths around the ends of blocks
        n = [43, 43, 43, 7, 8, 9, 15, 16, 17, 24][conv % 10]
        rows += [(conv, i, *long[i]) for i in range(n)]
    rows += [(300, i, "user", f"own {i}") for i in range(30)]
    rows += [(7, None, "user", "first of all"), (7, None, "user", "first of all"), (7, 0, "user", "a tie"), (None, 0, "user", "nobody's")]
    rows += [(401, 9_000 * i, "user", f"far apart {i}") for i in range(5)] + [(402, -7, "a", "below zero"), (402, 2, "a", "b")]
    rows += [(403, 1, "ab", "c"), (404, 1, "a", "bc"), (405, 1, "user", "one"), (406, 1, "user", "one")]
    return [row + CLASHING for row in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)


def test_trie_of_conversations_as_they_are(odd):
    assert rows_of(trie.conversation_trie(odd)) == expected(ordered(odd_rows()))


def test_query_rebuilds_conversations(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "conversations.parquet"))
    wanted = expected(rebuilt(ordered(odd_rows())))
    assert any(row[1] == 0 and row[7] != hashlib.sha256().hexdigest() for row in wanted)  # a turnless one
    assert rows_of(trie.op13_conversation_trie(spark, str(tmp_path))) == wanted


def test_no_conversations(spark):
    assert rows_of(trie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    nobody = spark.createDataFrame([(None, 1, "a", "b", *CLASHING)], SCHEMA)
    assert rows_of(trie.conversation_trie(nobody)) == []


def test_one_conversation_holds_most_turns(spark):
    """A conversation that is numbered and summed in several pieces, and a copy of its first part."""
    rows = [(1, i, "user", f"turn {i % 11}") for i in range(9_000)] + [(2, i, "user", f"turn {i % 11}") for i in range(4_500)]
    found = trie.conversation_trie(spark.createDataFrame([row + CLASHING for row in rows], SCHEMA)).cache()
    assert found.count() == 9_001
    assert found.where("n_convs = 2").count() == 4_501
    first = found.where("depth = 0").first()
    assert (first.n_leaves, first.n_children, first.saved_tokens) == (1, 1, 2 * 4_500)
    last = found.where("depth = 4500").first()
    assert last.ends_sha256 == hashlib.sha256(b"2").hexdigest() and last.conv_id == 1 and last.saved_tokens == 2


def test_sums_before_in_pieces(spark):
    rows = spark.range(50).select((F.col("id") % 2).alias("key"), F.floor(F.col("id") / 2).alias("at"), F.col("id").alias("v"))
    found = {(r.key, r.at): r.v for r in trie.sums_before(rows, "key", "at", ("v",), width=4).collect()}
    assert found == {(k, a): sum(2 * i + k for i in range(a)) for k in range(2) for a in range(25)}


def test_ids_of_a_common_end_meet_as_strings(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    ends = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("node"), F.col("id").alias("conv_id"))
    found = {r.node: r.ends_sha256 for r in trie._id_lists(ends.repartition(6)).collect()}
    assert found["hot"] == hashlib.sha256(",".join(map(str, range(0, 1000, 3))).encode()).hexdigest()
    assert found["7"] == hashlib.sha256(b"7").hexdigest() and len(found) == 667
