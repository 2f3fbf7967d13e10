"""Operator 13: the prefix trie of conversations, by ROLLUP over positional turn-id columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, word_count

#: Turns that one block of columns covers; longer conversations go on in further blocks.
BLOCK = 8
#: Consecutive numbers of one key that one window task adds up; the sums before them come from a table of totals.
PIECE = 4096
#: Conversation ids that are joined to one string before the strings of a node meet.
CHUNK_IDS = 4096
#: Hash sums of a prefix: four of 32-bit numbers in 64 bits, so 2^31 turns do not overflow them.
LANES = tuple(f"lane_{i}" for i in range(4))


def sums_before(rows: DataFrame, key: str, at: str, values: tuple[str, ...], width: int = PIECE) -> DataFrame:
    """Replaces ``values`` by their sums over the rows with the same key and a smaller ``at`` (whole numbers from 0).

    A key is cut into pieces of ``width`` numbers, so a key with very many rows is not one task's work; only keys with more
    than one piece have rows in the table of totals that is joined.
    """
    rows = rows.withColumn("_piece", F.floor(F.col(at) / width))
    totals = rows.groupBy(key, "_piece").agg(*(F.sum(x).alias(f"_t_{x}") for x in values))
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(key, "_piece", *(F.sum(f"_t_{x}").over(earlier).alias(f"_t_{x}") for x in values)).where("_piece > 0")
    inside = Window.partitionBy(key, "_piece").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    summed = rows.withColumns({x: F.coalesce(F.sum(x).over(inside), zero) for x in values}).join(totals, [key, "_piece"], "left")
    return summed.withColumns({x: F.col(x) + F.coalesce(F.col(f"_t_{x}"), zero) for x in values}).drop("_piece", *(f"_t_{x}" for x in values))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, n_words): the turns of each conversation in order, from place 1.

    A turn is known by 128 bits of SHA-256 over role and text, so texts are not shuffled. Null turns come first; turns of one
    number come in the order of their ids. Rows without conv_id belong to no conversation. A long conversation is
    numbered in ranges of its turn numbers.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn_id = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.floor(F.col("turn") / PIECE).alias("range"),
        turn_id.alias("turn_id"), word_count(text).alias("n_words"))
    within = Window.partitionBy("conv_id", "range").orderBy(F.col("turn").asc_nulls_first(), "turn_id")
    rows = rows.withColumn("place", F.row_number().over(within).cast("long"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("range").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    offsets = (counts.select(F.col("conv_id").alias("_conv"), F.col("range").alias("_range"), F.sum("n").over(earlier).alias("_before"))
               .where("_before > 0"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("range").eqNullSafe(F.col("_range"))
    return rows.join(offsets, same, "left").select(
        "conv_id", (F.col("place") + F.coalesce("_before", F.lit(0))).alias("place"), "turn_id", "n_words")


def with_shared_starts(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilds every conversation c: the first h turns of conversation c - c % group, then c's own turns after its first
    h, where h = crc32(c as decimal text) % most. Returns the turns and the ids of all conversations, turnless ones
    among them.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % group
    starts = (turns.where((F.col("place") < most) & (F.col("conv_id") == base))
              .groupBy(F.col("conv_id").alias("_base")).agg(F.sort_array(F.collect_list(F.struct("place", "turn_id", "n_words"))).alias("start")))
    members = turns.select("conv_id").distinct().select("conv_id", base.alias("_base"), h.alias("h")).join(starts, "_base", "left")
    members = members.select("conv_id", "h", F.coalesce(F.slice("start", F.lit(1), F.col("h").cast("int")), F.array()).alias("start"))
    given = members.select("conv_id", F.inline("start"))
    gaps = members.where(F.size("start") < F.col("h")).select(F.col("conv_id").alias("_conv"), (F.col("h") - F.size("start")).alias("gap"))
    own = turns.where(F.col("place") > h).join(gaps, F.col("conv_id") == F.col("_conv"), "left")
    own = own.select("conv_id", (F.col("place") - F.coalesce("gap", F.lit(0))).alias("place"), "turn_id", "n_words")
    return given.unionByName(own), members.select("conv_id")


def _lanes(place: Column, turn_id: Column) -> list[Column]:
    """What the turn at a place adds to the sums that name a prefix."""
    return [F.when(turn_id.isNull(), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64(F.lit(i), place, turn_id), 32)) for i in range(len(LANES))]


def _name(lanes: list[Column]) -> Column:
    return F.concat_ws(".", *(x.cast("string") for x in lanes))


def _blocks(scratch: Scratch, turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per conversation and block b: turn ids t1 to t7 of the turns after the first 8 b, their words w1 to w7 and
    w0 of turn 8 b, the sums that name the prefix of 8 b turns, those of turn 8 b alone, and n_here, the turns from here on
    (8 for more). A conversation of m turns has blocks 0 to m div 8, so block b's level 0 has all members of its node.
    """
    at = F.col("place") - 1
    here = turns.select("conv_id", F.floor(at / BLOCK).alias("block"), (at % BLOCK + 1).alias("slot"), "turn_id", "n_words")
    ends = turns.where(F.col("place") % BLOCK == 0).select(
        "conv_id", (F.col("place") / BLOCK).cast("long").alias("block"), F.lit(0).cast("long").alias("slot"), "turn_id", "n_words")
    firsts = members.select("conv_id", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("slot"),
                            F.lit(None).cast("binary").alias("turn_id"), F.lit(0).cast("long").alias("n_words"))
    cells = here.unionByName(ends).unionByName(firsts)
    place = F.col("block") * BLOCK + F.col("slot")
    cells = cells.withColumns(dict(zip(LANES, _lanes(place, F.col("turn_id")))))
    inner = F.col("slot") > 0
    blocks = cells.groupBy("conv_id", "block").agg(
        *(F.max(F.when(F.col("slot") == i, F.col("turn_id"))).alias(f"t{i}") for i in range(1, BLOCK)),
        *(F.max(F.when(F.col("slot") == i, F.col("n_words"))).alias(f"w{i}") for i in range(BLOCK)),
        *(F.sum(F.when(inner, F.col(x)).otherwise(0)).alias(x) for x in LANES),
        *(F.max(F.when(~inner, F.col(x))).alias(f"last_{x}") for x in LANES),
        F.count(F.when(inner, 1)).alias("n_here"))
    return scratch.store("blocks", sums_before(blocks, "conv_id", "block", LANES))


def _rollup(blocks: DataFrame, aggregates: str) -> DataFrame:
    """Aggregates the members of all prefixes at once: ROLLUP over the turn ids of a block, keyed by block and prior node.

    ``level`` is the number of turn ids a row is grouped by. Groups whose last turn id is missing are members that ended
    before it, and no nodes.
    """
    ids = [f"t{i}" for i in range(1, BLOCK)]
    rolled = blocks.sparkSession.sql(f"""
        SELECT block, {', '.join(LANES)}, {', '.join(ids)}, {BLOCK - 1} - bit_count(grouping_id()) AS level, {aggregates}
        FROM {{blocks}} GROUP BY block, {', '.join(LANES)}, ROLLUP({', '.join(ids)})""", blocks=blocks)
    there = reduce(lambda out, i: F.when(F.col("level") == i, F.col(f"t{i}").isNotNull()).otherwise(out), range(1, BLOCK), F.lit(True))
    return rolled.where(there)


def _node_lanes(level: Column) -> list[Column]:
    """The sums that name a node: the block's own and those of the turns up to the level."""
    out = [F.col(x) for x in LANES]
    for i in range(1, BLOCK):
        added = _lanes(F.col("block") * BLOCK + i, F.when(level >= i, F.col(f"t{i}")))
        out = [x + y for x, y in zip(out, added)]
    return out


def _id_lists(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from rows (node, conv_id): SHA-256 of the decimal ids in ascending order, joined by commas.

    Ids are sorted by range over all tasks and joined to strings there, so a node where a third of all conversations end
    costs one task only the hashing of its strings, one after the other; no list is held whole.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, out = None, [], ([], [], [])

        def close() -> None:
            out[0].append(now)
            out[1].append(ids[0])
            out[2].append(",".join(map(str, ids)))

        for batch in batches:
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (node != now or len(ids) == CHUNK_IDS):
                    close()
                    ids = []
                now = node
                ids.append(conv)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.string()))], ["node", "first", "ids"])
                out = ([], [], [])
        if ids:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.string()))], ["node", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            nodes, digests = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is not None and node == now:
                    digest.update(b"," + ids.encode())
                    continue
                if digest is not None:
                    nodes.append(now)
                    digests.append(digest.hexdigest())
                now, digest = node, hashlib.sha256(ids.encode())
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(digests)], ["node", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    strings = (ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
               .mapInArrow(joined, "node string, first long, ids string"))
    return strings.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix of the members' turns, the empty one included.

    ``turns`` has conv_id, place (from 1, without gaps), turn_id (binary) and n_words; ``members`` every conv_id once. Returns
    node (a name that only this run means), depth, conv_id (the smallest member), parent_conv_id (null for the root), n_convs,
    n_children, n_leaves and saved_tokens over the subtree, and ends_sha256 over the ids of members that end at the node.
    Without members there are no rows. A prefix is named by four sums of hashes of its turns and places.

    Sums over subtrees need no walk over the levels: a node's values are booked on its smallest member, and a subtree's sum
    is that of its members, less what its own smallest member has above the node. A second ROLLUP over the same rows adds
    it up. Nodes of one member are chains, which need none of this.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    blocks = _blocks(scratch, turns, members)
    words = ", ".join(f"max(w{i}) AS w{i}" for i in range(BLOCK))
    last = ", ".join(f"max(last_{x}) AS last_{x}" for x in LANES)
    counts = ", ".join(f"count_if(n_here = {i}) AS ends{i}" for i in range(BLOCK))
    rolled = _rollup(blocks, f"min(conv_id) AS conv_id, count(*) AS n_convs, {words}, {last}, {counts}")
    level = F.col("level")
    pick = lambda name: reduce(lambda out, i: F.when(level == i, F.col(f"{name}{i}")).otherwise(out), range(1, BLOCK), F.col(f"{name}0"))
    above = [F.when(level > 0, up).otherwise(F.col(x) - F.col(f"last_{x}")) for up, x in zip(_node_lanes(level - 1), LANES)]
    depth = F.col("block") * BLOCK + level
    nodes = rolled.select(
        _name(_node_lanes(level)).alias("node"), F.when(depth > 0, _name(above)).alias("parent"), depth.alias("depth"),
        "conv_id", "n_convs", (F.col("n_convs") == pick("ends")).alias("leaf"),
        ((F.col("n_convs") - 1) * pick("w")).alias("saved"))
    nodes = scratch.store("nodes", nodes)

    own = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum(F.col("leaf").cast("long")).alias("leaves"))
    shared = nodes.where("n_convs > 1")
    members_sums = _rollup(blocks.join(own, "conv_id", "left"), "count(*) AS n_convs, sum(coalesce(saved, 0)) AS all_saved, sum(coalesce(leaves, 0)) AS n_leaves")
    members_sums = members_sums.where("n_convs > 1").select(_name(_node_lanes(level)).alias("node"), "all_saved", "n_leaves")
    higher = sums_before(shared.select("node", "conv_id", "depth", F.col("saved").alias("above")), "conv_id", "depth", ("above",))
    sums = members_sums.join(higher.select("node", "above"), "node").select(
        "node", (F.col("all_saved") - F.col("above")).alias("saved_tokens"), "n_leaves")

    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    n_here = F.col("n_here")
    ends = _id_lists(blocks.where(n_here < BLOCK).select(_name(_node_lanes(n_here)).alias("node"), "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.select("node", "parent", "depth", "conv_id", "n_convs")
            .join(children, "node", "left").join(sums, "node", "left").join(ends, "node", "left").join(parents, "parent", "left")
            .select("node", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                    F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of the conversations as they are. Null role or text is empty; repeated rows are turns of their own;
    rows without conv_id are left out; other columns are not read; an empty table has no nodes."""
    scratch = Scratch(conversations.sparkSession, "turns")
    turns = scratch.store("turns", numbered_turns(conversations))
    return prefix_trie(turns, turns.select("conv_id").distinct())


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "turns")
    turns = scratch.store("turns", numbered_turns(spark.read.parquet(f"{folder}/conversations.parquet")))
    turns, members = with_shared_starts(turns)
    return prefix_trie(scratch.store("rebuilt", turns), scratch.store("members", members)).drop("node")


OP13_SQL = r"""
WITH own AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS place
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
members AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(CAST(conv_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i + 1, 1)) AS BIGINT))),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                 lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
parts AS (
  SELECT m.conv_id, o.role, o.text, 0 AS part, o.place FROM members m JOIN own o ON o.conv_id = m.base AND o.place <= m.h
  UNION ALL
  SELECT m.conv_id, o.role, o.text, 1 AS part, o.place FROM members m JOIN own o ON o.conv_id = m.conv_id AND o.place > m.h),
lists AS (
  SELECT m.conv_id, coalesce(list(sha256(length(p.role) || ':' || p.role || p.text) ORDER BY part, place) FILTER (p.part IS NOT NULL), []) AS turns,
         coalesce(list(len(regexp_extract_all(p.text, '[^\x20\x09-\x0D]+')) ORDER BY part, place) FILTER (p.part IS NOT NULL), []) AS words
  FROM members m LEFT JOIN parts p ON p.conv_id = m.conv_id GROUP BY m.conv_id),
steps AS (SELECT conv_id, turns, words, unnest(range(len(turns) + 1)) AS depth FROM lists),
prefixes AS (
  SELECT conv_id, depth, sha256(array_to_string(turns[1:depth], ',')) AS node,
         CASE WHEN depth > 0 THEN sha256(array_to_string(turns[1:depth - 1], ',')) END AS parent,
         CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS n_words, depth = len(turns) AS ends
  FROM steps),
nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n_words) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth),
kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node, depth)),
below AS (SELECT DISTINCT a.node, a.depth, b.node AS lower, b.depth AS lower_depth FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
  SELECT b.node, b.depth, sum(n.saved)::BIGINT AS saved_tokens, count_if(n.n_children = 0)::BIGINT AS n_leaves
  FROM below b JOIN full_nodes n ON n.node = b.lower AND n.depth = b.lower_depth GROUP BY b.node, b.depth)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (node, depth) LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
"""
