"""Operator 11: how two tokenizers cut the same bytes, counted over the corpus through a minimal perfect hash of id pairs."""

from __future__ import annotations

import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, mixed
from ledgerspark.llm.token_files import byte_characters, filesystem

#: Characters of the units that one worker remembers before it starts anew, and of those that it aligns together.
CACHE_CHARACTERS = 16_000_000
TOGETHER = 1 << 14
#: Characters of the texts whose units one worker looks up before it aligns the new ones.
TEXTS_CHARACTERS = 1 << 21
#: Pairs are dealt by hash into this many buckets; shards are ranges of them.
BUCKETS = 1 << 16
#: Pairs that a shard of the hash function has on average, at most.
SHARD_PAIRS = 1 << 15
#: Counts in one row of a vector, and how many vectors one step of the tree adds up.
VECTOR_ROW = 1 << 10
FAN = 64
#: Shards that a worker holds when it looks up counts.
HELD_SHARDS = 48

_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUTS = re.compile(r"(?<=\S)(?= +[^ ]|\n\S)")


class Tokenizers:
    """Both tokenizers, and units of texts: pieces whose tokens do not depend on what stands around them.

    A unit starts with a space or line feed after other than white space and goes on to the next. The byte-level tokenizer
    splits there before it merges. The other merges only to pieces of its vocabulary: none has a space after another character
    or a line feed, which is checked; if one had, a text would be one unit.
    """

    #: What stands before units that are encoded together: a word that is one token in both, so that all begin alike.
    BEFORE = " a"

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {c: bytes([b]) for b, c in byte_characters().items()}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [b"".join(byte_of.get(c, c.encode()) for c in name) for name in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
        self.by_unit = not any("\n" in x or "▁" in x.lstrip("▁") for x in pieces)
        # Ids as text, with what follows them within a group, at the end of its first half and at its end.
        self.a_text, self.a_last = self._texts(len(names), ","), self._texts(len(names), "|")
        self.b_text, self.b_last = self._texts(len(pieces), ","), self._texts(len(pieces), ";")
        self.a_size, self.b_size = (np.array([len(x) for x in found], np.int64) for found in (self.a_bytes, self.b_bytes))

    @staticmethod
    def _texts(n: int, after: str) -> np.ndarray:
        out = np.empty(n, object)
        out[:] = [f"{i}{after}" for i in range(n)]
        return out

    def units(self, text: str) -> list[str]:
        """The units of a space and the text, by name: a unit without its first space, unless white space of a unit follows that."""
        if not self.by_unit:
            return [self.name(" " + text)]
        plain = not (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
                     or _OTHER_SPACE.search(text))
        return text.replace("\n", " \n").split(" ") if plain else list(map(self.name, _CUTS.split(" " + text)))

    @staticmethod
    def name(unit: str) -> str:
        return unit[1:] if unit[0] == " " and unit[1:2] not in ("", " ", "\n") else unit

    @staticmethod
    def spelled(name: str) -> str:
        """The unit of a name."""
        return name if name[0] in " \n" else " " + name

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of units one after the other, or None where the tokens do not spell them."""
        before = self.BEFORE if self.by_unit else ""
        whole = before + "".join(texts)
        a, b = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids, self.b.encode(whole[1:])
        wanted = whole.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != wanted or b"".join(map(self.b_bytes.__getitem__, b)) != wanted:
            return None
        skip = 1 if before else 0
        if skip and (self.a_bytes[a[0]] != before.encode() or self.b_bytes[b[0]] != before.encode()):
            raise ValueError("units cannot be encoded together with these tokenizers")
        return np.array(a[skip:], np.int64), np.array(b[skip:], np.int64)


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


class Units(dict):
    """The number of each unit that was met since the last ``clear``; units that wait are aligned together by ``resolve``.

    By number, after that: ``valid`` (whether tokens spell the unit), ``sizes`` (tokens of both, groups and links, one row each) and
    ``groups`` (their text). ``links`` are those of all units in order, as codes with the first id in the upper half.
    """

    def __init__(self, tokenizers: Tokenizers) -> None:
        super().__init__()
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.waiting, self.alone, self.characters, self.groups = [], set(), 0, []
        self.valid, self.sizes, self.links = np.zeros(0, bool), np.zeros((4, 0), np.int64), np.zeros(0, np.int64)

    def __missing__(self, name: str) -> int:
        number = self[name] = len(self)
        text = self.tokenizers.spelled(name)
        self.waiting.append(text)
        self.characters += len(text) + 20
        return number

    def of_text(self, text: str | None) -> list[int]:
        """The units of a text in order."""
        if not text:
            return []
        known, numbers = len(self), list(map(self.__getitem__, self.tokenizers.units(text)))
        # A unit that ends in white space ends its text, and nothing may follow it.
        if numbers[-1] >= known and (text[-1].isspace() or not self.tokenizers.by_unit):
            self.alone.add(numbers[-1] - len(self) + len(self.waiting))
        return numbers

    def resolve(self) -> None:
        valid, sizes, links = [self.valid], [self.sizes], [self.links]
        ends, start = np.cumsum([len(text) for text in self.waiting], dtype=np.int64), 0
        for stop in sorted({*self.alone, *(i + 1 for i in self.alone), len(self.waiting)}):
            while start < stop:
                before = ends[start - 1] if start else 0
                last = min(stop, max(start + 1, int(np.searchsorted(ends, before + TOGETHER, side="right"))))
                self._align(self.waiting[start:last], valid, sizes, links)
                start = last
        self.waiting, self.alone = [], set()
        self.valid, self.sizes, self.links = np.concatenate(valid), np.concatenate(sizes, axis=1), np.concatenate(links)

    def _align(self, texts: list[str], valid: list, sizes: list, links: list) -> None:
        """Two tokens overlap where a stretch between two ends of any tokens lies in both; each such stretch is one link."""
        if not texts:
            return
        found = self.tokenizers.encoded(texts)
        if found is None and len(texts) > 1:
            for text in texts:
                self._align([text], valid, sizes, links)
            return
        if found is None:
            valid.append(np.zeros(1, bool))
            sizes.append(np.zeros((4, 1), np.int64))
            self.groups.append("")
            return
        a, b = found
        tokenizers, n = self.tokenizers, len(texts)
        unit_ends = np.cumsum([len(text.encode()) for text in texts])
        a_ends, b_ends = np.cumsum(tokenizers.a_size[a]), np.cumsum(tokenizers.b_size[b])
        both = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        again = both[1:] == both[:-1]
        common, ends = both[1:][again], both[np.append(True, ~again)]
        unit_of = lambda at: np.bincount(np.searchsorted(unit_ends, at), minlength=n)
        valid.append(np.ones(n, bool))
        sizes.append(np.stack([unit_of(a_ends), unit_of(b_ends), unit_of(common), unit_of(ends)]))
        links.append(a[np.searchsorted(a_ends, ends)] << 32 | b[np.searchsorted(b_ends, ends)])
        group = np.concatenate([2 * np.searchsorted(common, a_ends), 2 * np.searchsorted(common, b_ends) + 1])
        ends_group = np.zeros(int(ends[-1]) + 1, bool)
        ends_group[common] = True
        pieces = np.concatenate([np.where(ends_group[a_ends], tokenizers.a_last[a], tokenizers.a_text[a]),
                                 np.where(ends_group[b_ends], tokenizers.b_last[b], tokenizers.b_text[b])])
        pieces = pieces[np.argsort(group, kind="stable")].tolist()
        stops = np.cumsum(sizes[-1][0] + sizes[-1][1]).tolist()
        self.groups += ["".join(pieces[start:stop]) for start, stop in zip([0, *stops], stops)]


_units: dict[tuple[str, str], Units] = {}


def units_of(a_path: str, b_path: str) -> Units:
    """The units that this worker remembers from earlier tasks, of either pass."""
    if (a_path, b_path) not in _units:
        _units[a_path, b_path] = Units(tokenizers_of(a_path, b_path))
    return _units[a_path, b_path]


def aligned_texts(units: Units, texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The units of some texts, one after the other, and where each text starts, with the end last. A text with a unit that
    tokens do not spell has none."""
    units.resolve()
    lengths = np.array([len(numbers) for numbers in texts], np.int64)
    flat = np.fromiter(chain.from_iterable(texts), np.int64, int(lengths.sum()))
    if not units.valid.all():
        owner = np.repeat(np.arange(len(texts)), lengths)
        spelled = np.ones(len(texts), bool)
        spelled[owner[~units.valid[flat]]] = False
        flat, lengths = flat[spelled[owner]], np.where(spelled, lengths, 0)
    return flat, np.concatenate([[0], np.cumsum(lengths)])


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: levels of bit arrays, twice as long as the keys they get.

    On a level, keys that meet no other at their place have a bit there; the others go to the next level. The index of a key
    is the number of bits before its own, over all levels.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        counts = [np.bitwise_count(words).astype(np.int64) for words in levels]
        before = np.cumsum([0, *(int(c.sum()) for c in counts)])
        self.ranks = [start + np.cumsum(c) - c for start, c in zip(before, counts)]
        self.size = int(before[-1])

    @staticmethod
    def _places(keys: np.ndarray, level: int, n_words: int) -> np.ndarray:
        seed = mixed(np.array([level + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
        return mixed(keys ^ seed) % np.uint64(64 * n_words)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left):
            n_words = -(-len(left) // 32)
            at = cls._places(left, len(levels), n_words)
            alone = np.bincount(at.astype(np.int64), minlength=64 * n_words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; of a key that was not given, any index or -1."""
        keys = keys.astype(np.uint64)
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = self._places(keys[left], level, len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            there = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[there]] = (ranks[word] + np.bitwise_count(below))[there]
            left = left[~there]
        return out


class Shard:
    """One shard: its hash function, its keys by index (a key is only found where it stands), and counts if there are any."""

    def __init__(self, function: PerfectHash, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.function, self.keys, self.counts = function, keys, counts

    @classmethod
    def of(cls, keys: np.ndarray) -> Shard:
        function = PerfectHash.build(keys)
        by_index = np.empty(len(keys), np.int64)
        by_index[function.index(keys)] = keys
        return cls(function, by_index)

    def index(self, pairs: np.ndarray) -> np.ndarray:
        found = self.function.index(pairs)
        if len(pairs) and ((found < 0).any() or (self.keys[found] != pairs).any()):
            raise KeyError("a pair of ids is not in the hash of all pairs: the documents changed while they were read")
        return found

    def write(self, folder: str) -> str:
        name, out = f"{uuid.uuid4().hex}.npz", io.BytesIO()
        parts = {f"level{i}": words for i, words in enumerate(self.function.levels)} | {"keys": self.keys}
        np.savez(out, **parts, **({} if self.counts is None else {"counts": self.counts}))
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{name}") as file:
            file.write(out.getvalue())
        return name

    @classmethod
    def read(cls, folder: str, name: str) -> Shard:
        store, path = filesystem(folder)
        with store.open_input_file(f"{path}/{name}") as file:
            parts = np.load(io.BytesIO(file.read()))
        levels = [parts[f"level{i}"] for i in range(len(parts.files)) if f"level{i}" in parts.files]
        return cls(PerfectHash(levels), parts["keys"], parts["counts"] if "counts" in parts.files else None)


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    return (mixed(pairs.astype(np.uint64)) >> np.uint64(48)).astype(np.int64)


def _batches(columns: dict[str, tuple], n: int, size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for start in range(0, n, size):
        yield pa.RecordBatch.from_arrays([pa.array(values[start:start + size], kind) for values, kind in columns.values()], list(columns))


def _sorted_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of batches with one value of the keys, by which the rows come sorted."""
    for batch in batches:
        if not batch.num_rows:
            continue
        found = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in found:
            change[1:] |= column[1:] != column[:-1]
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield tuple(int(c[start]) for c in found), batch.slice(start, stop - start)


def _together(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column, some at a time; a long one alone."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py())
        size += len(some[-1] or "")
        if size > TEXTS_CHARACTERS:
            yield some
            some, size = [], 0
    if some:
        yield some


def _partial_counts(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """First pass: (pair, n, bucket, part) with the links of each pair in the units a task remembers at a time."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, part = units_of(a_path, b_path), TaskContext.get().partitionId()
        times = np.zeros(0, np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal times
            if times.any():
                weights = np.repeat(times, units.sizes[3])
                met = weights > 0
                pairs, place = np.unique(units.links[met], return_inverse=True)
                n = np.zeros(len(pairs), np.int64)
                np.add.at(n, place, weights[met])
                yield from _batches({"pair": (pairs, pa.int64()), "n": (n, pa.int64()), "bucket": (bucket_of(pairs), pa.int64()),
                                     "part": (np.full(len(pairs), part), pa.int64())}, len(pairs))
            times = np.zeros(0, np.int64)

        for batch in batches:
            for texts in _together(batch.column(0)):
                flat, _ = aligned_texts(units, [units.of_text(text) for text in texts])
                new = np.bincount(flat, minlength=len(units.valid))
                new[:len(times)] += times
                times = new
                if units.characters > CACHE_CHARACTERS:
                    yield from flush()
                    units.clear()
        yield from flush()

    return documents.select("text").mapInArrow(counted, "pair long, n long, bucket long, part long")


def _build_shards(pairs: DataFrame, width: int, folder: str) -> DataFrame:
    """(shard, name) of the files that hold each shard's function and keys; ``width`` buckets make a shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys = None, []

        def close() -> pa.RecordBatch:
            name = Shard.of(np.concatenate(keys)).write(folder)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([name])], ["shard", "name"])

        for (shard,), rows in _sorted_groups(batches, ("shard",)):
            if shard != now and keys:
                yield close()
                keys = []
            now = shard
            keys.append(np.asarray(rows.column("pair")))
        if keys:
            yield close()

    dealt = pairs.select("pair", F.floor(F.col("bucket") / width).alias("shard"))
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(build, "shard long, name string")


def _vectors(partial: DataFrame, width: int, folder: str, names: dict[int, str], fan: int) -> DataFrame:
    """Leaves of the tree: dense vectors of counts by hash index, one for each shard and ``fan`` parts, in rows of VECTOR_ROW."""

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard, counts = None, None, None

        def rows() -> Iterator[pa.RecordBatch]:
            starts = range(0, len(counts), VECTOR_ROW)
            yield pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * len(starts), pa.int64()), pa.array(range(len(starts)), pa.int64()),
                 pa.array([now[1]] * len(starts), pa.int64()), pa.array([counts[i:i + VECTOR_ROW].tobytes() for i in starts], pa.binary())],
                ["shard", "block", "leaf", "counts"])

        for key, part in _sorted_groups(batches, ("shard", "leaf")):
            if key != now:
                if now is not None:
                    yield from rows()
                if now is None or key[0] != now[0]:
                    shard = Shard.read(folder, names[key[0]])
                now, counts = key, np.zeros(shard.function.size, np.int64)
            np.add.at(counts, shard.index(np.asarray(part.column("pair"))), np.asarray(part.column("n")))
        if now is not None:
            yield from rows()

    dealt = partial.select("pair", "n", F.floor(F.col("bucket") / width).alias("shard"), F.floor(F.col("part") / fan).alias("leaf"))
    return (dealt.repartition("shard", "leaf").sortWithinPartitions("shard", "leaf")
            .mapInArrow(leaves, "shard long, block long, leaf long, counts binary"))


def _added(vectors: DataFrame, fan: int) -> DataFrame:
    """One step up the tree: the sums of ``fan`` vectors each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        keys = ("shard", "block", "leaf")

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in now), pa.array([total.tobytes()], pa.binary())], [*keys, "counts"])

        for key, rows in _sorted_groups(batches, keys):
            for counts in rows.column("counts"):
                vector = np.frombuffer(counts.as_buffer(), np.int64)
                if key != now:
                    if now is not None:
                        yield row()
                    now, total = key, vector.copy()
                else:
                    total += vector
        if now is not None:
            yield row()

    up = vectors.withColumn("leaf", F.floor(F.col("leaf") / fan))
    return (up.repartition("shard", "block", "leaf").sortWithinPartitions("shard", "block", "leaf")
            .mapInArrow(add, "shard long, block long, leaf long, counts binary"))


def _finished(vectors: DataFrame, folder: str, names: dict[int, str]) -> DataFrame:
    """Writes shards with their counts: (shard, name, b, most), the highest count of each second id in the shard."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, []

        def rows() -> Iterator[pa.RecordBatch]:
            shard = Shard.read(folder, names[now])
            shard.counts = np.concatenate(counts)
            name = shard.write(folder)
            b, place = np.unique(shard.keys & 0xFFFFFFFF, return_inverse=True)
            most = np.zeros(len(b), np.int64)
            np.maximum.at(most, place, shard.counts)
            yield from _batches({"shard": (np.full(len(b), now), pa.int64()), "name": ([name] * len(b), pa.string()),
                                 "b": (b, pa.int64()), "most": (most, pa.int64())}, len(b))

        for (shard,), part in _sorted_groups(batches, ("shard",)):
            if shard != now:
                if now is not None:
                    yield from rows()
                now, counts = shard, []
            counts += [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("counts")]
        if now is not None:
            yield from rows()

    return (vectors.repartition("shard").sortWithinPartitions("shard", "block")
            .mapInArrow(finish, "shard long, name string, b long, most long"))


class Counts:
    """Looks counts up in the files of the shards, of which a worker holds a few at a time."""

    def __init__(self, folder: str, names: dict[int, str], width: int) -> None:
        self.folder, self.names, self.width, self.held = folder, names, width, {}

    def shard(self, number: int) -> Shard:
        found = self.held.pop(number, None) or Shard.read(self.folder, self.names[number])
        self.held[number] = found
        if len(self.held) > HELD_SHARDS:
            del self.held[next(iter(self.held))]
        return found

    def of(self, pairs: np.ndarray) -> np.ndarray:
        out, shards = np.empty(len(pairs), np.int64), bucket_of(pairs) // self.width
        order = np.argsort(shards, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1) if len(pairs) else ():
            shard = self.shard(int(shards[some[0]]))
            out[some] = shard.counts[shard.index(pairs[some])]
        return out


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def aligned_tokens(documents: DataFrame, a_path: str, b_path: str, fan: int = FAN) -> DataFrame:
    """Per document: the tokens of both tokenizers (n_a, n_b), the groups between bytes where both end, the links (token pairs
    whose bytes overlap), n_best (links whose count is the highest of their second id), count_sum and groups_sha256.

    ``a_path`` is a byte-level tokenizer, given a space and the text; ``b_path`` a piece model, which adds the space itself.
    Pass 1 counts links per task. The distinct pairs, dealt into shards by hash, get a minimal perfect hash each, whose keys
    are kept and compared at every look-up. Counts become dense vectors by hash index, which are added up in a tree,
    ``fan`` at a time. Pass 2 aligns the documents again and looks up counts in the shards' files, of which a worker
    holds HELD_SHARDS. To the driver come the shards' file names (at most BUCKETS) and one number per id of the second vocabulary.

    Null and empty texts, and texts that the tokens do not spell, have zeros and an empty groups_sha256. Repeated rows and null
    ids are rows like others; other columns are not read; an empty table gives no rows. Texts are taken whole.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "alignment")
    folder = scratch.path("shards")
    partial = scratch.store("partial", _partial_counts(documents, a_path, b_path))
    pairs = scratch.store("pairs", partial.select("pair", "bucket").distinct())
    n_pairs = pairs.count()
    width = BUCKETS
    while width > 1 and n_pairs * width > SHARD_PAIRS * BUCKETS:
        width //= 2
    names = {row["shard"]: row["name"] for row in scratch.store("functions", _build_shards(pairs, width, folder)).collect()}
    vectors, step = scratch.store("vectors-0", _vectors(partial, width, folder, names, fan)), 0
    while vectors.where("leaf > 0").limit(1).count():
        step += 1
        vectors = scratch.store(f"vectors-{step}", _added(vectors, fan))
    finished = scratch.store("counts", _finished(vectors, folder, names))
    filled = {row["shard"]: row["name"] for row in finished.select("shard", "name").distinct().collect()}
    best = {row["b"]: row["most"] for row in finished.groupBy("b").agg(F.max("most").alias("most")).collect()}
    best_of = np.zeros(max(best, default=0) + 1, np.int64)
    best_of[list(best)] = list(best.values())
    scratch.drop("partial", "pairs", *(f"vectors-{i}" for i in range(step + 1)))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, counts = units_of(a_path, b_path), Counts(folder, filled, width)
        known, ready = np.zeros((2, 0), np.int64), np.zeros(0, bool)

        def learn(flat: np.ndarray) -> None:
            """Looks up the sums of units that are new. Units of texts that cannot be aligned were not counted."""
            nonlocal known, ready
            more = len(units.valid) - len(ready)
            known, ready = np.pad(known, ((0, 0), (0, more))), np.pad(ready, (0, more))
            new = np.zeros(len(ready), bool)
            new[flat] = True
            new &= ~ready
            n_links = units.sizes[3]
            pairs, place = np.unique(units.links[np.repeat(new, n_links)], return_inverse=True)
            if not len(pairs):
                return
            n = counts.of(pairs)
            top = (n == best_of[pairs & 0xFFFFFFFF]).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(n_links[new])])[:-1]
            known[:, new] = [np.add.reduceat(top[place], starts), np.add.reduceat(n[place], starts)]
            ready |= new

        for batch in batches:
            start = 0
            for texts in _together(batch.column(1)):
                flat, ends = aligned_texts(units, [units.of_text(text) for text in texts])
                learn(flat)
                running = np.zeros((6, len(flat) + 1), np.int64)
                np.cumsum(np.concatenate([units.sizes, known])[:, flat], axis=1, out=running[:, 1:])
                sums, numbers = running[:, ends[1:]] - running[:, ends[:-1]], flat.tolist()
                digests = [hashlib.sha256("".join(map(units.groups.__getitem__, numbers[first:last]))[:-1].encode()).hexdigest() if last > first else ""
                           for first, last in zip(ends.tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), *(pa.array(column) for column in sums), pa.array(digests, pa.string())],
                    [name.split()[0] for name in _RESULT.split(", ")])
                start += len(texts)
                if units.characters > CACHE_CHARACTERS:
                    units.clear()
                    known, ready = known[:, :0], ready[:0]

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(looked_up, _RESULT)


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return aligned_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
