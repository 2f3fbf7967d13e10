"""Operator 7: language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import ship, slices, text_bytes

#: Longest context in bytes.
ORDER = 3
#: The learned sample of a language: at most so many distinct texts, and so many bytes after its first text.
SAMPLE_DOCS = 400
SAMPLE_BYTES = 400_000
#: Groups in which a language's documents are drawn first.
SPREAD = 64
#: Documents up to this size come first into the sample.
SHORT_BYTES = 1 << 16

UNDETERMINED = "und"


class ContextTrees:
    """Byte context trees of several languages with frozen counts.

    In a context seen with n symbols of d kinds, a symbol seen c times has probability c / (n + d); the escape d / (n + d)
    leads to the context one byte shorter, and at last to equal probabilities of all 256 bytes. ``bits`` holds the
    resulting exact code length of each symbol in each context that any language has seen; ``state`` leads
    from the last ORDER bytes to the longest such context. Bytes that no language has seen share symbol 0,
    which also stands before each text.
    """

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.languages = sorted(samples)
        texts = {name: [t.encode() for t in samples[name]] for name in self.languages}
        seen = sorted(set(b"".join(t for ts in texts.values() for t in ts)))
        self.symbol = np.zeros(256, np.int64)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.size = size = len(seen) + 1
        streams = {name: np.concatenate([np.concatenate([np.zeros(ORDER, np.int64), self.symbol[np.frombuffer(t, np.uint8)]])
                                         for t in ts] or [np.zeros(0, np.int64)]) for name, ts in texts.items()}
        # Contexts of each order as numbers in base ``size``, of all languages together; order 0 is state 0.
        contexts = [np.zeros(1, np.int64)]
        for order in range(1, ORDER + 1):
            found = [self._contexts(s, order)[0] for s in streams.values()]
            contexts.append(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64))
        starts = np.cumsum([0, *map(len, contexts)])
        self.bits = np.empty((starts[-1], size, len(self.languages)), np.float32)
        for number, name in enumerate(self.languages):
            self.bits[:, :, number] = self._code_lengths(streams[name], contexts, starts)
        history = np.arange(size**ORDER, dtype=np.int64)
        self.state = np.zeros(len(history), np.int32)
        for order in range(1, ORDER + 1):
            tail = history % size**order
            at = np.minimum(np.searchsorted(contexts[order], tail), max(len(contexts[order]) - 1, 0))
            known = contexts[order][at] == tail if len(contexts[order]) else np.zeros(len(tail), bool)
            self.state[known] = starts[order] + at[known]

    def _contexts(self, stream: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Context and symbol of each byte of the sample."""
        places = np.flatnonzero(stream)
        context = np.zeros(len(places), np.int64)
        for back in range(order, 0, -1):
            context = context * self.size + stream[places - back]
        return context, stream[places]

    def _code_lengths(self, stream: np.ndarray, contexts: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
        chance = np.empty((starts[-1], self.size))
        shorter = np.full((1, self.size), 1 / 256)
        for order, known in enumerate(contexts):
            context, symbol = self._contexts(stream, order)
            counts = np.zeros((len(known), self.size))
            np.add.at(counts, (np.searchsorted(known, context), symbol), 1)
            n, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
            if order > 1:
                parent = shorter[np.searchsorted(contexts[order - 1], known % self.size ** (order - 1))]
            else:
                parent = np.broadcast_to(shorter[0], counts.shape)
            with np.errstate(divide="ignore", invalid="ignore"):
                here = np.where(counts > 0, counts / (n + kinds), kinds / (n + kinds) * parent)
            shorter = np.where(n > 0, here, parent)
            chance[starts[order] : starts[order + 1]] = shorter
        return -np.log2(chance)

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each text under each language; data and starts as of ``text_bytes``."""
        out = np.zeros((len(starts) - 1, len(self.languages)))
        full = np.flatnonzero(np.diff(starts))
        if not len(full):
            return out
        symbols = self.symbol[data]
        history = np.zeros(len(data), np.int64)
        for back in range(ORDER, 0, -1):
            history *= self.size
            history[back:] += symbols[:-back]
        # The bytes before a text are none of its own.
        for place in range(ORDER):
            at = starts[full] + place
            at = at[place < np.diff(starts)[full]]
            history[at] %= self.size**place
        bits = self.bits[self.state[history], symbols]
        out[full] = np.add.reduceat(bits, starts[full], axis=0, dtype=np.float64)
        return out


def sample_texts(documents: DataFrame, learn: Column) -> dict[str, list[str]]:
    """The bounded sample: for each language the texts with the smallest hash, whole, short ones first; copies are one text."""
    known = documents.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull())
    key = {"lang": F.col("lang"), "size": F.octet_length("text"), "draw": F.xxhash64("text")}
    rows = known.select(*(column.alias(name) for name, column in key.items())).distinct()
    order = [F.col("size") > SHORT_BYTES, "draw", "size"]

    def least(rows: DataFrame, *group: str) -> DataFrame:
        return rows.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("n") <= SAMPLE_DOCS)

    # First within ranges of the hash, so that the candidates of a language in one task are bounded too.
    first = least(least(rows.withColumn("part", F.pmod("draw", F.lit(SPREAD))), "lang", "part"), "lang")
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    chosen = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < SAMPLE_BYTES)
    keys = chosen.select(*(F.col(name).alias(f"_{name}") for name in key))
    same = [column == F.col(f"_{name}") for name, column in key.items()]
    # At most SAMPLE_DOCS keys for each language.
    found = known.join(F.broadcast(keys), same, "left_semi").select("lang", "text").distinct().collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(found):
        samples.setdefault(row.lang, []).append(row.text)
    return samples


def identify_language(documents: DataFrame, learn: Column | None = None) -> DataFrame:
    """Predicts the language of every whole text: doc_id, lang_pred, score, bits, n_bytes.

    The trees are learned from the sample of rows for which ``learn`` holds (default: all with a language); a document's
    language is the one under which its bytes have the shortest code. ``score`` is that language's probability
    given the code lengths, 0 to 1; ``bits`` is its code length. Text that is null or without letters is ``und`` with score
    0, and so is every text where there is nothing to learn from. Ties go to the first language by code point. The
    model's size depends on the sample's bounds and the number of languages only. One row per row of the input, null or
    repeated ids included; other columns are not read.
    """
    model = _learned(documents, learn)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                names, score, bits, sizes = _scored(model.value, part.column(1), part.column(2))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(bits), pa.array(sizes)],
                    ["doc_id", "lang_pred", "score", "bits", "n_bytes"])

    return documents.select("doc_id", "text", _letter()).mapInArrow(
        predict, "doc_id long, lang_pred string, score double, bits double, n_bytes long")


def in_known_language(documents: DataFrame, learn: Column | None = None) -> DataFrame:
    """The rows, with all their columns, whose text has letters and that some learned language writes in fewer than the
    8 bits a byte of plain storage. Rows are judged one by one, without a join; where there is nothing to learn from, none
    stays."""
    model = _learned(documents, learn)
    columns = documents.columns
    at = columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(at)):
                part = batch.slice(start, stop - start)
                names, _, bits, sizes = _scored(model.value, part.column(at), part.column(len(columns)))
                known = np.array([name != UNDETERMINED for name in names], bool) & (bits < 8 * sizes)
                rows = part.filter(pa.array(known))
                yield pa.RecordBatch.from_arrays([rows.column(i) for i in range(len(columns))], columns)

    return documents.select(*(documents[c] for c in columns), _letter()).mapInArrow(keep, documents.schema)


def _letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter")


def _learned(documents: DataFrame, learn: Column | None) -> Broadcast:
    ship(documents.sparkSession)
    samples = sample_texts(documents, F.lit(True) if learn is None else learn)
    return documents.sparkSession.sparkContext.broadcast(ContextTrees(samples) if samples else None)


def _scored(trees: ContextTrees | None, texts: pa.Array, letters: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, code length in bits and bytes of each text."""
    data, starts = text_bytes(texts)
    letters = np.array(letters.to_pylist(), bool)
    names, score, least = [UNDETERMINED] * len(letters), np.zeros(len(letters)), np.zeros(len(letters))
    if trees and len(letters):
        bits = trees.code_lengths(data, starts)
        least = bits.min(1)
        score = np.where(letters, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1), 0.0)
        names = [trees.languages[i] if x else UNDETERMINED for i, x in zip(bits.argmin(1), letters)]
    return names, score, least, np.diff(starts)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; a null id is not held out, and not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    found = identify_language(documents, F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
