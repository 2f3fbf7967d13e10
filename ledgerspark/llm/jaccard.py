"""Operator 5: near-duplicate classes by a join on shingle sets, filtered under several global token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, Words, components, gram_codes, mixed, slices

#: Words of a shingle.
SHINGLE = 5
#: Two sets are linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Token orders: by code (chooses documents), by frequency (makes candidates), and by these many hashes (must agree).
HASH_ORDERS = 2
#: The head of the order by code: tokens below this share of all codes. A set with more tokens of its own than a link allows
#: is out; with a larger share, chance keeps fewer of them.
HEAD = 5 / 16
#: Bits, by a hash of doc_id, that tell which texts are wanted again; they are broadcast at this size whatever the input's. Bits of
#: other documents only let a few more texts through to the exact join.
MARKS = 1 << 25
MARKS_ROW = 1 << 15
#: Links are counted between blocks of sets of one class: so many tokens and sets are a block, on average.
BLOCK_TOKENS = 1 << 17
BLOCK_SETS = 512


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit codes of each text's shingles."""
    words = Words(texts, lower=True)
    codes = gram_codes(words.codes, SHINGLE)
    short = {n: mixed(gram_codes(words.codes, n) + np.uint64(n)) for n in range(1, SHINGLE) if len(words.codes) >= n}
    for first, n in zip(words.firsts, words.count):
        if n >= SHINGLE:
            yield np.unique(codes[first : first + n - SHINGLE + 1])
        elif n:
            yield short[n][first : first + 1]
        else:
            yield np.zeros(0, np.uint64)


def prefix_length(n: int) -> int:
    """Tokens of a set of n of which one at least is shared with any linked set, in any order."""
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def hash_prefix(codes: np.ndarray, number: int) -> np.ndarray:
    """The prefix of a set in an order by a hash."""
    rank = mixed(codes + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return codes[np.argsort(rank)[: prefix_length(len(codes))]]


def signature(codes: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits that tell sets apart."""
    return mixed(codes).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(codes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), initial=np.uint64(0))


def _signed(values: list) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _facts(documents: DataFrame) -> DataFrame:
    """Per document its set's size and signature, and the head of its tokens in the order by code."""
    bound = np.uint64(int(HEAD * 2**64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                sets = list(shingle_sets(batch.column(1).slice(start, stop - start)))
                one, two = zip(*(signature(codes) for codes in sets))
                heads = [codes[: np.searchsorted(codes, bound)].view(np.int64) for codes in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array([len(x) for x in sets], pa.int64()), _signed(one), _signed(two),
                     pa.array(heads, pa.list_(pa.int64()))], ["doc_id", "n", "s1", "s2", "head"])

    return documents.select("doc_id", "text").mapInArrow(read, "doc_id long, n long, s1 long, s2 long, head array<long>")


def _sets(documents: DataFrame) -> DataFrame:
    """(doc_id, s1, n, codes, p0, p1): the sets that have the wanted signature, and their prefixes in the orders by hash."""
    names = [f"p{i}" for i in range(HASH_ORDERS)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0).to_numpy(), np.stack([batch.column(i).to_numpy() for i in (2, 3)], 1).view(np.uint64)
            for start, stop in slices(batch.column(1)):
                sets = list(shingle_sets(batch.column(1).slice(start, stop - start)))
                at = [i for i, codes in enumerate(sets) if signature(codes) == tuple(wanted[start + i])]
                lists = [[sets[i] for i in at]] + [[hash_prefix(sets[i], k) for i in at] for k in range(HASH_ORDERS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[start + i] for i in at], pa.int64()), _signed([wanted[start + i, 0] for i in at]),
                     pa.array([len(sets[i]) for i in at], pa.int32()),
                     *(pa.array([x.view(np.int64) for x in rows], pa.list_(pa.int64())) for rows in lists)],
                    ["doc_id", "s1", "n", "codes", *names])

    schema = "doc_id long, s1 long, n int, codes array<long>, " + ", ".join(f"{x} array<long>" for x in names)
    return documents.select("doc_id", "text", "s1", "s2").mapInArrow(read, schema)


def _wanted(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, text, s1, s2) of chosen documents. A text whose bit is not marked is not moved for the join."""

    def place(shown: DataFrame) -> DataFrame:
        bit = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
        return shown.withColumn("mark_row", F.floor(bit / MARKS_ROW)).withColumn("bit", (bit % MARKS_ROW).cast("int"))

    dealt = place(chosen.select("doc_id")).repartition("mark_row")
    marks = dealt.groupBy("mark_row").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.expr("substring(bits, bit div 8 + 1, 1)")), 16, 10).cast("int")
    marked = place(documents.where("doc_id IS NOT NULL").select("doc_id", "text")).join(F.broadcast(marks), "mark_row").where(
        byte.bitwiseAND(F.expr("shiftleft(1, bit % 8)")) != 0)
    return marked.select("doc_id", "text").join(chosen, "doc_id")


def _prefix_column(n: Column) -> Column:
    return n - F.floor((n * PERCENT + 99) / 100) + 1


def _chosen(scratch: Scratch, facts: DataFrame, labelled: DataFrame) -> DataFrame:
    """(doc_id, s1, s2) of the sets that may have a link: one of each group of equal sets, without those that have more tokens
    of their own in the head than a linked set can have in all."""
    units = labelled.where("first = doc_id").distinct()
    heads = facts.where("doc_id IS NOT NULL").select("doc_id", F.explode("head").alias("token"))
    # Whoever holds a token shares it with all copies: it is its group's own if it comes as often as the group has rows.
    held = heads.groupBy("token").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id"))
    own = scratch.store("own", held.groupBy("doc_id", "c").agg(F.count("*").alias("own")))
    # The sets under one doc_id share the count, which says nothing about each of several.
    several = units.groupBy("doc_id").agg(F.count("*").alias("sets")).where("sets > 1").select("doc_id", F.lit(True).alias("several"))
    kept = units.join(own, ["doc_id", "c"], "left").join(several, "doc_id", "left").where(
        F.col("own").isNull() | F.col("several") | (F.col("own") < _prefix_column(F.col("n"))))
    return scratch.store("chosen", kept.select("doc_id", "s1", "s2").distinct())


def _members(scratch: Scratch, sets: DataFrame) -> DataFrame:
    """(token, doc_id, n, place): prefixes in the order by frequency among the chosen sets, of tokens that two prefixes hold.

    Tokens of one set only come first and can meet nothing, so they are counted and not moved: the place of a token is the
    set's size less its rank from the end.
    """
    tokens = sets.select("doc_id", "s1", "n", F.explode("codes").alias("token"))
    frequency = scratch.store("frequency", tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"))
    from_end = F.row_number().over(Window.partitionBy("doc_id", "s1").orderBy(F.desc("c"), F.desc("token")))
    placed = tokens.join(frequency, "token").withColumn("place", (F.col("n") - from_end).cast("int"))
    prefixes = scratch.store("prefixes", placed.where(F.col("place") < _prefix_column(F.col("n"))).select("token", "doc_id", "n", "place"))
    groups = scratch.store("groups", prefixes.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token"))
    members = scratch.store("members", prefixes.join(groups, "token"))
    scratch.drop("frequency", "prefixes", "groups")
    return members


def _reachable(n1: Column, place1: Column, n2: Column, place2: Column) -> Column:
    """Whether two sets can be linked if a token at these places is the first that they share."""
    return F.least(n1 - place1, n2 - place2).cast("long") * (100 + PERCENT) >= (n1 + n2).cast("long") * PERCENT


def _verified(scratch: Scratch, turn: int, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that also share prefix tokens in every other order, and of those the ones similar enough."""
    others = [f"p{i}" for i in range(HASH_ORDERS)]

    def side(name: str, columns: list[str]) -> DataFrame:
        return sets.select(F.col("doc_id").alias(name), *(F.col(x).alias(f"{name}_{x}") for x in columns))

    left = pairs.join(side("a", others), "a").join(side("b", others), "b")
    for x in others:
        left = left.where(F.arrays_overlap(f"a_{x}", f"b_{x}"))
    left = scratch.store(f"left-{turn}", left.select("a", "b"))
    rows = left.join(side("a", ["n", "codes"]), "a").join(side("b", ["n", "codes"]), "b")
    shared = F.size(F.array_intersect("a_codes", "b_codes")).cast("long")
    enough = shared * (100 + PERCENT) >= (F.col("a_n") + F.col("b_n")) * PERCENT
    return scratch.store(f"links-{turn}", rows.where(enough).select("a", "b").distinct())


def _pair() -> list[Column]:
    return [F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")]


def _bits(n: Column) -> Column:
    """Binary digits of a size. Linked sets have as many, or one more or less."""
    return F.length(F.bin(n))


def _cells(scratch: Scratch, sets: DataFrame, found: DataFrame) -> DataFrame:
    """(component, zone, i, j, doc_id, s1, n, side): which sets meet in which cells, so that any two of a class that their
    sizes allow to be linked meet in one cell.

    An even zone of a class has the sets whose sizes have so many binary digits; the odd one behind it has those at the border
    to one digit more. Each zone is dealt into blocks by a hash, and any two of its blocks are a cell.
    """
    named = found.select(F.col("node").alias("doc_id"), "component")
    ids = sets.select("doc_id", "s1", "n").distinct().join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    bits, n, border = _bits(F.col("n")), F.col("n").cast("long"), F.col("border")
    zones = F.filter(F.array(2 * bits, F.when(n * 100 >= border * PERCENT, 2 * bits + 1),
                             F.when(n * PERCENT <= (border / 2 - 1) * 100, 2 * bits - 1)), lambda zone: zone.isNotNull())
    placed = scratch.store("zones", ids.withColumn("border", F.expr("shiftleft(1L, length(bin(n)))")).select(
        "component", F.explode(zones).alias("zone"), "doc_id", "s1", "n"))
    parts = F.ceil(F.greatest(F.sum(F.col("n").cast("long")) / BLOCK_TOKENS, F.count("*") / BLOCK_SETS)).cast("int")
    sizes = placed.groupBy("component", "zone").agg(parts.alias("blocks"), F.count("*").alias("c"), F.min(bits).alias("low"), F.max(bits).alias("high"))
    met = placed.join(sizes.where("c > 1 AND (zone % 2 = 0 OR low < high)").select("component", "zone", "blocks"), ["component", "zone"])
    block = F.pmod(F.xxhash64("doc_id", "s1"), F.col("blocks")).cast("int")
    dealt = met.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("component", "zone", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "doc_id", "s1", "n",
                        (F.col("block") > F.col("other")).alias("side"))


def _links_in_cell(key: tuple, cell: pa.Table) -> pa.Table:
    """(doc_id, s1, n, links) of the sets of a cell, by exact comparison of all pairs: sets are rows of bits over the tokens that
    several of them hold."""
    names = [cell.column(x).to_pylist() for x in ("doc_id", "s1", "n")]
    # Rows that repeat a document and its text are one set.
    at = list({name: i for i, name in reversed(list(enumerate(zip(*names))))}.values())
    lists = cell.column("codes").combine_chunks().take(pa.array(at, pa.int64()))
    n = np.array([names[2][i] for i in at], np.int64)
    _, tokens, held = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
    number = np.cumsum(held > 1) - 1
    several, rows = held[tokens] > 1, np.repeat(np.arange(len(at)), n)
    rows, tokens = rows[several], number[tokens[several]]
    bits = np.zeros((len(at), (int(number[-1]) >> 6) + 1), np.uint64)
    np.bitwise_or.at(bits, (rows, tokens >> 6), np.uint64(1) << (tokens & 63).astype(np.uint64))
    side = cell.column("side").to_numpy()[at]
    one, border = key[2].as_py() == key[3].as_py(), key[1].as_py() % 2
    low = n < 1 << key[1].as_py() // 2
    links = np.zeros(len(at), np.int64)
    for i in np.flatnonzero(~side):
        others = np.arange(i + 1, len(at)) if one else np.flatnonzero(side)
        others = others[np.minimum(n[i], n[others]) * 100 >= np.maximum(n[i], n[others]) * PERCENT]
        if border:
            others = others[low[others] != low[i]]
        shared = np.bitwise_count(bits[i] & bits[others]).sum(1, dtype=np.int64)
        linked = others[shared * (100 + PERCENT) >= (n[i] + n[others]) * PERCENT]
        links[i] += len(linked)
        links[linked] += 1
    return pa.table({x: pa.array([y[i] for i in at], cell.schema.field(x).type) for x, y in zip(("doc_id", "s1", "n"), names)} | {"links": links})


def _degrees(scratch: Scratch, sets: DataFrame, found: DataFrame) -> DataFrame:
    """(first, s1, n, n_links): to how many other sets each set is linked; sets without links may be missing.

    Only sets of one class can be linked. All pairs of a class are compared, cell by cell, so the work grows with the square of
    a class's sets and the rows that are moved with that square over the size of a block.
    """
    cells = scratch.store("cells", _cells(scratch, sets, found))
    codes = cells.join(sets.select("doc_id", "s1", "n", "codes"), ["doc_id", "s1", "n"])
    met = codes.groupBy("component", "zone", "i", "j").applyInArrow(_links_in_cell, "doc_id long, s1 long, n int, links long")
    return scratch.store("degree", met.where("links > 0").groupBy(F.col("doc_id").alias("first"), "s1", "n").agg(F.sum("links").alias("n_links")))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Classes of documents whose sets of 5-word shingles are linked, directly or by others: doc_id, n_shingles,
    component_id (the smallest doc_id within reach), n_links (the sets other than its own that its set is linked to).

    Equal sets are one candidate, the smallest doc_id. In the order of codes a set is out if too many of its tokens are its own.
    Prefixes in the order of exact frequencies among the sets left hold a token of every linked pair, and a token that many
    unlike documents share seldom comes that early. Members of a token's group are first compared with two of them only; a
    pair that this has put into one class needs no comparison of its own. Then all remaining pairs of different classes are
    compared. A pair must be within reach by length and place, share prefix tokens in every
    order, and then pass the exact comparison of both sets. This gives the classes; at last all pairs of different sets of
    each class are compared for ``n_links``, in cells of bounded size.

    Text without words (or null) is linked with nothing. Rows that share a doc_id are one document and in one class, whatever
    their texts. A null doc_id is returned with a null class. Empty tables give no rows; other columns are not read.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "jaccard")
    facts = scratch.store("facts", _facts(documents))
    rows = scratch.store("rows", facts.select("doc_id", "n", "s1", "s2"))
    known = rows.where("doc_id IS NOT NULL")
    classes = scratch.store("classes", known.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")))
    labelled = scratch.store("labelled", known.join(classes, ["n", "s1", "s2"], "left"))
    chosen = _chosen(scratch, facts, labelled)
    scratch.drop("facts", "classes", "own")
    sets = scratch.store("sets", _sets(_wanted(documents, chosen)))
    members = _members(scratch, sets)

    repeated = labelled.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    links = scratch.store("links-0", labelled.join(repeated, "doc_id").where("first IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct())
    checked = found = None
    for turn in (1, 2):
        if turn == 1:
            placed = members.withColumn("component", F.col("doc_id"))
            # Two members of each token's group: the one with the smallest id, the same for all tokens of a class, and the one
            # that has the token earliest, whose rare tokens do not come before what the group has in common.
            rank = ["doc_id", "n", "place", "component"]
            least = F.min(F.struct(F.lit(0.0).alias("share"), *rank)), F.min(F.struct((F.col("place") / F.col("n")).alias("share"), *rank))
            hubs = placed.groupBy("token").agg(F.array(*least).alias("hubs")).select("token", F.explode("hubs").alias("hub")).select(
                "token", *(F.col(f"hub.{x}") for x in rank)).toDF("token", "other", "other_n", "other_place", "other_component")
            pairs = placed.join(scratch.store("hubs", hubs.distinct()), "token")
        else:
            # All pairs of different classes that are left, each from the side outside the group's largest class.
            named = found.select(F.col("node").alias("doc_id"), "component")
            now = scratch.store("now", members.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")))
            span = now.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            placed = scratch.store("placed", now.join(scratch.store("mixed", span.where("low <> high").select("token")), "token"))
            sizes = placed.groupBy("token", "component").agg(F.count("*").alias("c"))
            main = scratch.store("main", sizes.groupBy("token").agg(F.max(F.struct("c", "component")).alias("m")).select("token", F.col("m.component").alias("main")))
            strays = placed.join(main, "token").where("component <> main").select("token", "doc_id", "n", "place", "component", "main")
            strays = scratch.store("strays", strays).toDF("token", "other", "other_n", "other_place", "other_component", "main")
            pairs = placed.join(strays, "token").where((F.col("component") == F.col("main")) | (F.col("doc_id") < F.col("other")))
        pairs = pairs.where(F.col("component") != F.col("other_component")).where(
            _reachable(F.col("n"), F.col("place"), F.col("other_n"), F.col("other_place"))).select(*_pair()).distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = scratch.store(f"pairs-{turn}", pairs)
        if turn == 1 or not pairs.isEmpty():
            checked = pairs if checked is None else checked.union(pairs)
            links = links.union(_verified(scratch, turn, pairs, sets))
            found = components(scratch, f"c{turn}", links)
            scratch.drop(f"left-{turn}")
        scratch.drop("hubs", "now", "mixed", "placed", "main", "strays")
    scratch.drop("members", "chosen")
    found = scratch.store("components", found)
    degree = _degrees(scratch, sets, found)
    scratch.drop("sets", "zones", "cells")
    named = found.select(F.col("node").alias("first"), "component")
    out = labelled.withColumn("first", F.coalesce("first", "doc_id")).join(named, "first", "left").join(degree, ["first", "s1", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "first").alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links")).union(
        rows.where("doc_id IS NULL").select("doc_id", "n", F.lit(None).cast("long"), F.lit(0).cast("long")))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
