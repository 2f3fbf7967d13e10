"""Operator 9: documents that hold benchmark items, found by BM25 with block-max WAND and verified exactly."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import Words, gram_codes, mixed, ship, slices

#: A passage is two neighbouring chunks of a document; the next passage starts one chunk later.
CHUNK = 64
#: Retrieved are all pairs whose BM25 score is at least this share of the item's score with itself.
THRESHOLD = 0.6
#: Share of an item's 5-word shingles that a document must hold. Those of question and answer are told only: one changed
#: word takes five shingles, which can be all of a short answer.
SIMILARITY = 0.8
K1, B = 1.2, 0.75
#: Blocks of an index, and bytes of item text in one index; more items make more indexes, each with its own pass.
BLOCKS = 32
INDEX_BYTES = 8 << 20
SHINGLE = 5


def question_and_answer(text: str) -> tuple[str, str]:
    """The item up to its last sentence, and that sentence; an item of one sentence is a question without answer."""
    ends = [m.end() for m in re.finditer(r"[.!?:][ \t\r\n]+|[\r\n]+", text.rstrip())]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def shingle_codes(codes: np.ndarray) -> np.ndarray:
    """Codes of all 5-word shingles; of fewer words, one code for all of them."""
    if len(codes) >= SHINGLE:
        return gram_codes(codes, SHINGLE)
    return mixed(gram_codes(codes, len(codes)) + np.uint64(len(codes))) if len(codes) else np.zeros(0, np.uint64)


class Index:
    """An inverted index of items with BM25 impacts, as shares of each item's score with itself.

    Items longer than a chunk are indexed in parts, so that some passage holds every part whole. Parts are numbered in
    blocks; ``block_max`` has the highest impact of a term in each block.
    """

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.items = []
        rows, self.part_item = [], []
        for item_id, text in items:
            halves = [Words(pa.array([x]), plain=True).codes for x in question_and_answer(text)]
            codes = np.concatenate(halves)
            if not len(codes):
                continue
            number = len(self.items)
            self.items.append((item_id, len(codes), *((len(x), np.unique(shingle_codes(x))) for x in [codes, *halves])))
            for start in range(0, len(codes), CHUNK):
                rows.append(codes[start : start + CHUNK])
                self.part_item.append(number)
        self.part_item = np.array(self.part_item, np.int64)
        n = len(rows)
        lengths = np.array([len(x) for x in rows], float)
        part = np.repeat(np.arange(n), lengths.astype(int))
        self.vocabulary, term = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.uint64), return_inverse=True)
        pair, tf = np.unique(term * max(n, 1) + part, return_counts=True)
        term, part = pair // max(n, 1), pair % max(n, 1)
        df = np.bincount(term, minlength=len(self.vocabulary))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[part] / max(lengths.mean() if n else 1, 1)))
        impact /= np.bincount(part, impact, minlength=n)[part] if n else 1
        self.size, self.part, self.impact = max(1, -(-n // BLOCKS)), part, impact
        self.first = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        self.term_max = np.zeros(len(self.vocabulary))
        np.maximum.at(self.term_max, term, impact)
        self.block_max = np.zeros((len(self.vocabulary), BLOCKS), np.float32)
        np.maximum.at(self.block_max, (term, part // self.size), impact.astype(np.float32))
        # Terms without which a part's other terms stay below the threshold: WAND's pivots.
        order = np.lexsort((impact, part))
        below = np.cumsum(impact[order])
        starts = np.searchsorted(part[order], np.arange(n))
        below -= np.repeat(np.append(0, below)[starts], np.diff(np.append(starts, len(order)))) if n else 0
        self.pivot = np.zeros(len(self.vocabulary), bool)
        self.pivot[term[order][below >= THRESHOLD - 1e-6]] = True
        self.near = np.zeros(1 << 20, bool)
        self.near[self.vocabulary >> np.uint64(44)] = True

    def retrieve(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word in the text, part and score of all passages and parts at or above the threshold."""
        none = tuple(np.zeros(0, np.int64) for _ in range(4))
        at = np.flatnonzero(self.near[words.codes >> np.uint64(44)])
        if not len(at) or not len(self.vocabulary):
            return none
        term = np.minimum(np.searchsorted(self.vocabulary, words.codes[at]), len(self.vocabulary) - 1)
        hit = self.vocabulary[term] == words.codes[at]
        at, term = at[hit], term[hit]
        owner = np.searchsorted(words.firsts, at, side="right") - 1
        chunks = -(-words.count // CHUNK)
        base = np.cumsum(chunks) - chunks
        chunk = base[owner] + (at - words.firsts[owner]) // CHUNK
        # Passages by their first chunk: without a pivot, no part can reach the threshold.
        n = int(chunks.sum())
        some = np.zeros(n + 1, bool)
        some[chunk[self.pivot[term]]] = True
        last = np.zeros(n + 1, bool)
        last[(base + chunks - 1)[chunks > 0]] = True
        live = some[:-1] | (some[1:] & ~last[:-1])
        alone = np.zeros(n, bool)
        alone[base[chunks == 1]] = True
        live &= ~last[:-1] | alone
        pair = np.unique(chunk * len(self.vocabulary) + term)
        chunk, term = pair // len(self.vocabulary), pair % len(self.vocabulary)
        # Each pair of chunk and term stands in the passage that starts there and in the one before.
        here = live[chunk]
        before = (chunk > 0) & live[chunk - 1] & ~last[chunk - 1]
        passage = np.concatenate([chunk[here], chunk[before] - 1])
        pair = np.unique(passage * len(self.vocabulary) + np.concatenate([term[here], term[before]]))
        passage, term = pair // len(self.vocabulary), pair % len(self.vocabulary)
        if not len(passage):
            return none
        # Upper bounds of whole lists, then of blocks.
        keep = np.bincount(passage, self.term_max[term], minlength=n)[passage] >= THRESHOLD - 1e-6
        passage, term = passage[keep], term[keep]
        if not len(passage):
            return none
        starts = np.flatnonzero(np.append(True, np.diff(passage) > 0))
        bounds = np.add.reduceat(self.block_max[term], starts, axis=0)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(passage))))
        alive = bounds >= THRESHOLD - 1e-4
        keep = alive.any(1)[group]
        passage, term, group = passage[keep], term[keep], group[keep]
        # Exact scores of the postings that lie in blocks still alive.
        many = self.first[term + 1] - self.first[term]
        posting = np.repeat(self.first[term] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        row = np.repeat(np.arange(len(term)), many)
        keep = alive[group[row], self.part[posting] // self.size]
        posting, row = posting[keep], row[keep]
        parts = len(self.part_item)
        key, where = np.unique(passage[row] * parts + self.part[posting], return_inverse=True)
        score = np.bincount(where, self.impact[posting], minlength=len(key))
        key, score = key[score >= THRESHOLD], score[score >= THRESHOLD]
        passage = key // parts
        text = np.searchsorted(base + chunks, passage, side="right")
        return text, (passage - base[text]) * CHUNK, key % parts, score

    def verified(self, words: Words) -> list[tuple[int, int, int, float, float, float, float]]:
        """Text, item, first word and score of the best passage that passes, and the shares of all, question and answer."""
        retrieved: dict[tuple[int, int], dict[int, float]] = {}
        for t, f, p, s in zip(*self.retrieve(words)):
            places = retrieved.setdefault((int(t), int(self.part_item[p])), {})
            places[int(f)] = max(places.get(int(f), 0.0), float(s))
        out = []
        for (t, number), places in sorted(retrieved.items()):
            item_id, n, *parts = self.items[number]
            first = np.array(sorted(places), np.int64)
            score = np.array([places[f] for f in first.tolist()])
            # The words around each passage in which the whole item may lie.
            start = np.maximum(first - n, 0)
            stop = np.minimum(first + 2 * CHUNK + n, words.count[t])
            shares = np.empty((len(parts), len(first)))
            # Ranges that overlap are read as one.
            for near in np.split(np.arange(len(first)), np.flatnonzero(start[1:] > stop[:-1]) + 1):
                low, high = start[near[0]], stop[near[-1]]
                codes = words.codes[words.firsts[t] + low : words.firsts[t] + high]
                for share, (size, own) in zip(shares, parts):
                    share[near] = self._shares(codes, size, own, start[near] - low, stop[near] - low)
            passed = np.flatnonzero(shares[0] >= SIMILARITY)
            if len(passed):
                best = passed[np.argmax(score[passed])]
                out.append((t, item_id, int(first[best]), float(score[best]), *shares[:, best].tolist()))
        return out

    @staticmethod
    def _shares(codes: np.ndarray, size: int, own: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Share of the shingles of ``size`` words of an item that each range of the codes holds; ranges are in order."""
        if not len(own):
            return np.ones(len(starts))
        n = min(size, SHINGLE)
        here = gram_codes(codes, n)
        if n < SHINGLE:
            here = mixed(here + np.uint64(n))
        kind = np.minimum(np.searchsorted(own, here), len(own) - 1)
        place = np.flatnonzero(own[kind] == here)
        order = place[np.argsort(kind[place], kind="stable")]
        before = np.full(len(here), -1)
        again = kind[order[1:]] == kind[order[:-1]]
        before[order[1:][again]] = order[:-1][again]
        # A place counts in the ranges that hold it and not the same shingle before it.
        low = np.maximum(np.searchsorted(starts, before[place], side="right"), np.searchsorted(stops - n, place))
        high = np.maximum(low, np.searchsorted(starts, place, side="right"))
        many = np.bincount(low, minlength=len(starts) + 1) - np.bincount(high, minlength=len(starts) + 1)
        return np.cumsum(many)[: len(starts)] / len(own)


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds: doc_id, item_id, first_word, score, overlap,
    question_overlap, answer_overlap.

    Every passage of every document is a BM25 query; all parts of items that score at least THRESHOLD of what
    they score with themselves are retrieved and verified, and the pair stays if the words around one of them hold SIMILARITY
    of the item's 5-word shingles; told is the passage of the highest score, then the first, among those, with the shares
    of question and answer, which decide nothing. Words are compared in lower case and without
    marks. Items are read in indexes of bounded size, one pass over the documents each. Null or wordless items and
    texts match nothing; documents and items with a null or repeated id are judged by row; empty tables give no rows;
    other columns are not read.
    """
    schema = "doc_id long, item_id long, first_word long, score double, overlap double, question_overlap double, answer_overlap double"
    names = [x.split()[0] for x in schema.split(", ")]

    def against(index: Broadcast) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, stop in slices(batch.column(1)):
                    found = index.value.verified(Words(batch.column(1).slice(start, stop - start), plain=True))
                    if found:
                        ids = batch.column(0).slice(start, stop - start).take(pa.array([x[0] for x in found]))
                        rest = zip(*(x[1:] for x in found))
                        kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
                        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(rest, kinds))], names)

        return documents.select("doc_id", "text").mapInArrow(find, schema)

    found = documents.sparkSession.createDataFrame([], schema)
    for index in indexes(items):
        found = found.union(against(index))
    return found


def indexes(items: DataFrame) -> Iterator[Broadcast]:
    """Indexes of at most about INDEX_BYTES of item text each."""
    spark = items.sparkSession
    ship(spark)
    items = items.select("item_id", "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // INDEX_BYTES)
    for number in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == number).collect()
        yield spark.sparkContext.broadcast(Index(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))))


def clean_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, with all their columns, whose text holds no item; they are judged one by one, without a join."""
    columns, kept = documents.columns, documents
    at = columns.index("text")

    def without(index: Broadcast):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, stop in slices(batch.column(at)):
                    part = batch.slice(start, stop - start)
                    clean = np.ones(part.num_rows, bool)
                    clean[[x[0] for x in index.value.verified(Words(part.column(at), plain=True))]] = False
                    yield part.filter(pa.array(clean))

        return keep

    for index in indexes(items):
        kept = kept.mapInArrow(without(index), documents.schema)
    return kept


def op9_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
