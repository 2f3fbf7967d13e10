"""Operator 10: token ids in a binary format of byte planes, each compressed by zstandard, with a chunk index."""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch

MAGIC = b"LSPLANE1"
#: Ids in a block; the last block of a file is shorter.
BLOCK_IDS = 1 << 16
#: Blocks in a chunk: what a reader decodes at once.
CHUNK_BLOCKS = 4
#: Encoded words that one Python worker remembers before it starts anew.
CACHE_WORDS = 500_000
END_ID = 2

_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
_MARKS = b".,;:!?"
_encoders: dict[str, "Encoder"] = {}


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level tokenizer writes each byte: itself if it prints, else one from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """Ids of texts as little-endian 32-bit bytes; a dictionary of words that were met before.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its words; words
    recur, and a bounded memory holds their ids. Letters and the marks after them are pieces of their own in this
    tokenizer, in lower case, so that words that differ in case or marks share work, and the merges are asked for
    the piece directly. All other words go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Only a tokenizer with this form of splitting is taken apart; for any other, texts are encoded whole.
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        cut = json.dumps(steps.get("pre_tokenizer"))
        kinds = [x.get("type") for x in (steps.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and '"Removed"' in cut and "[^\\\\s" in cut
        self.model = self.tokenizer.model
        self.character = byte_characters()
        self.pieces: dict[bytes, bytes] = {}

    def raw(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: bytes) -> bytes:
        if (found := self.pieces.get(piece)) is None:
            text = piece.decode() if piece.isascii() else "".join(map(self.character.__getitem__, piece))
            found = self.pieces[piece] = array("I", [x.id for x in self.model.tokenize(text)]).tobytes()
        return found

    def word(self, word: bytes) -> bytes:
        letters = word.rstrip(_MARKS)
        if letters.isalpha():  # of bytes: ASCII letters
            marks = word[len(letters):]
            return self.piece(letters.lower()) + (self.piece(marks) if marks else b"")
        text = word.decode()
        if simple := _SIMPLE.fullmatch(text):
            piece, marks = simple.groups()
            return self.piece(piece.lower().encode()) + (self.piece(marks.encode()) if marks else b"")
        return self.raw(text)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.pieces.clear()
        found = self[word] = self.word(word)
        return found

    def text(self, text: bytes) -> bytes:
        if not self.by_word:
            return self.raw(text.decode())
        return b"".join(map(self.__getitem__, text.split()))


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def packed(ids: np.ndarray) -> list[bytes]:
    """The four byte planes of some blocks of ids, each compressed: all lowest bytes first, and so on."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return [zstandard.ZstdCompressor(level=3).compress(plane.tobytes()) for plane in planes]


def unpacked(planes: list[bytes], n: int) -> np.ndarray:
    out = np.empty((4, n), np.uint8)
    for row, plane in zip(out, planes):
        row[:] = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane, max_output_size=max(n, 1)), np.uint8)
    return np.ascontiguousarray(out.T).view("<u4").reshape(-1)


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{os.path.abspath(folder)}")


class PlaneWriter:
    """One file: MAGIC, chunks of compressed planes, the chunk index, its length and MAGIC again.

    The index has for each chunk: position, ids, and the four plane lengths. It writes under a name that no other
    attempt of the task uses; only files of finished tasks are listed, so a lost executor leaves at most a stray file.
    """

    def __init__(self, folder: str) -> None:
        self.name = f"{uuid.uuid4().hex}.planes"
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        self.out = store.open_output_stream(f"{path}/{self.name}")
        self.out.write(MAGIC)
        self.at, self.index, self.waiting, self.n = len(MAGIC), [], bytearray(), 0

    def add(self, ids: bytes) -> None:
        self.waiting += ids
        self.n += len(ids) // 4
        whole = 4 * BLOCK_IDS * CHUNK_BLOCKS
        while len(self.waiting) >= whole:
            self._chunk(bytes(self.waiting[:whole]))
            del self.waiting[:whole]

    def _chunk(self, ids: bytes) -> None:
        planes = packed(np.frombuffer(ids, "<u4"))
        self.index.append(struct.pack("<6Q", self.at, len(ids) // 4, *map(len, planes)))
        for plane in planes:
            self.out.write(plane)
            self.at += len(plane)

    def close(self) -> None:
        if self.waiting:
            self._chunk(bytes(self.waiting))
        index = b"".join(self.index)
        self.out.write(index + struct.pack("<Q", len(index)) + MAGIC)
        self.out.close()


def read_planes(folder: str, name: str) -> Iterator[np.ndarray]:
    """The ids of a file, chunk by chunk."""
    store, path = filesystem(folder)
    with store.open_input_file(f"{path}/{name}") as file:
        size = file.size()
        file.seek(size - 8 - len(MAGIC))
        (length,) = struct.unpack("<Q", file.read(8))
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{name} is not a whole file of planes")
        file.seek(size - 8 - len(MAGIC) - length)
        for at, n, *lengths in struct.iter_unpack("<6Q", file.read(length)):
            file.seek(at)
            yield unpacked([file.read(x) for x in lengths], n)


def write_token_files(documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the ids of all texts, each followed by ``end_id``, in ascending doc_id order.

    One file for each range of ids. Returns one row per document: doc_id, shard (its file's place in the order), name,
    place (the document's in the file), n_tokens. Null text is empty; a null id comes first; rows with one id are ordered
    by a hash of their text, so that many of them need not meet in one file. Texts are encoded whole, and only one chunk of
    ids waits in memory. The ranges are drawn from ids and hashes; no text reaches the driver.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, place = encoder(tokenizer), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or PlaneWriter(folder)
            lengths = []
            for text in batch.column(1).cast(pa.large_binary()):
                ids = encode.text(text.as_py() or b"") + struct.pack("<I", end_id)
                writer.add(ids)
                lengths.append(len(ids) // 4)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([writer.name] * n), pa.array(np.arange(place, place + n)),
                 pa.array(lengths, pa.int64())], ["doc_id", "shard", "name", "place", "n_tokens"])
            place += n
        if writer:
            writer.close()

    key = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ordered = (documents.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange(*key)
               .sortWithinPartitions(*key).select("doc_id", "text", F.spark_partition_id().alias("shard")))
    return ordered.mapInArrow(write, "doc_id long, shard int, name string, place long, n_tokens long")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """Reads back the files of ``write_token_files``: doc_id, shard, place, n_tokens, ids_crc32 of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by shard and place; a partition may hold several shards.
        now, chunks, have = None, None, np.zeros(0, "<u4")
        for batch in batches:
            sums = []
            for name, n in zip(batch.column("name").to_pylist(), batch.column("n_tokens").to_pylist()):
                if name != now:
                    now, chunks, have = name, read_planes(folder, name), np.zeros(0, "<u4")
                crc = 0
                while n:
                    if not len(have):
                        have = next(chunks)
                    part, have = have[:n], have[n:]
                    crc, n = zlib.crc32(part.tobytes(), crc), n - len(part)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("doc_id", "shard", "place", "n_tokens")), pa.array(sums, pa.int64())],
                ["doc_id", "shard", "place", "n_tokens", "ids_crc32"])

    return (files.repartition("shard").sortWithinPartitions("shard", "place")
            .mapInArrow(read, "doc_id long, shard int, place long, n_tokens long, ids_crc32 long"))


def token_digest(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the token files into the shared folder, reads them back and returns, per document, doc_id, start (ids of
    all documents before it), n_tokens and ids_crc32 (of the ids as little-endian 32-bit numbers), shard.

    Starts are running sums within a file plus the totals of the files before it: one row per file meets in one task.
    Nulls, ties and empty texts as in ``write_token_files``; an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "tokens")
    folder = scratch.path("files")
    files = scratch.store("written", write_token_files(documents, folder, tokenizer, end_id))
    sizes = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.store("offsets", sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    read = read_token_files(files, folder)
    within = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (read.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
            .join(F.broadcast(offsets), "shard")
            .select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", "shard"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_digest(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
