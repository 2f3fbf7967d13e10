"""The alignment of two tokenizers against one worked out text by text without units, hashes or partial sums."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerspark.llm import alignment
from ledgerspark.llm.token_files import byte_characters
from tests.llm.conftest import SCHEMA, odd_rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    def __init__(self) -> None:
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte_of = {c: b for b, c in byte_characters().items()}

    def tokens(self, text: str | None) -> tuple[list, list]:
        if not text:
            return [], []
        first = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.byte_of[c] for c in t)) for i, t in zip(first.ids, first.tokens)]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(tokens: list) -> list[tuple]:
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def aligned(a: list, b: list) -> tuple[list, str]:
    a, b = spans(a), spans(b)
    ends = sorted({x[2] for x in a} & {x[2] for x in b})
    a_ends, b_ends = np.array([x[2] for x in a]), np.array([x[2] for x in b])
    a_starts, b_starts = np.array([x[1] for x in a]), np.array([x[1] for x in b])
    links = [(x[0], b[j][0]) for x in a for j in np.flatnonzero((b_starts < x[2]) & (b_ends > x[1]))]
    groups, start = [], 0
    for end in ends:
        part = ["", ""]
        for k, (ids, starts, stops) in enumerate([(a, a_starts, a_ends), (b, b_starts, b_ends)]):
            part[k] = ",".join(str(ids[i][0]) for i in np.flatnonzero((starts >= start) & (stops <= end)))
        groups.append("|".join(part))
        start = end
    return links, groups


def expected(rows: list[tuple]) -> list[tuple]:
    plain, found, counts = Plain(), [], Counter()
    for row in rows:
        a, b = plain.tokens(row[1])
        links, groups = aligned(a, b) if a else ([], [])
        counts.update(links)
        found.append((row[0], len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(((doc, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for doc, n_a, n_b, groups, links in found), key=str)


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


STRANGE = [
    "a  b", " a", "a ", "  ", " ", "\n", "a\n", "\na", "a\n\nb", "a \n b", "a\n b", "a \nb", "a\t b", "a  b", "a  b", "a\r\nb\r\n\r\nc", "tab\tonly\tshort",
    "<|endoftext|> and <s> </s> <unk> <0x0A>", "under ▁ block", "▁", "it's we'll I'M", "x" * 3000, "日本語の 文章", "é ﬁ Ａ",
    "\U0001F600\U0001F601 ok", "a\x00b \x00", "\x1c \x1c\n\x1d x", "1234567 89,01 3.14", "a b   c", "!!! ??? ...\n...", "end\n   ", "\n\n\nstart", "a\x85b", "    indented\n        more",
]


def strange_rows() -> list[tuple]:
    return [(i, t, "en", "a", 1, -1, "x", 3, -7, 9, "y", "z", 0, 2, "n") for i, t in enumerate(STRANGE)]


@pytest.fixture(scope="module")
def wanted_odd():
    return expected(odd_rows())


def test_odd_documents(odd, wanted_odd):
    assert found(alignment.aligned_tokens(odd, A, B)) == wanted_odd


def test_units_end_where_tokens_do(spark):
    """Texts whose white space, marks and special names are most likely to be cut differently in parts."""
    rows = strange_rows()
    assert found(alignment.aligned_tokens(spark.createDataFrame(rows, SCHEMA).repartition(4), A, B)) == expected(rows)


def test_small_shards_small_memory_and_a_tall_tree(spark, odd, wanted_odd, monkeypatch):
    counts = alignment._partial_counts(odd.repartition(7), A, B)
    pairs = counts.select("pair", "bucket").distinct()
    monkeypatch.setattr(alignment, "SHARD_PAIRS", 64)
    monkeypatch.setattr(alignment, "HELD_SHARDS", 2)
    assert pairs.count() > 64 * 8
    assert found(alignment.aligned_tokens(odd.repartition(7), A, B, fan=2)) == wanted_odd


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(alignment.op11_token_alignment(spark, "/root/testdata/sf0.001")) == expected(rows)


def test_no_documents(spark, empty):
    assert found(alignment.aligned_tokens(empty, A, B)) == []
    nothing = spark.createDataFrame([row[:1] + (None,) + row[2:] for row in strange_rows()[:2]], SCHEMA)
    assert found(alignment.aligned_tokens(nothing, A, B)) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_a_worker_starts_anew_when_its_memory_is_full(monkeypatch):
    monkeypatch.setattr(alignment, "TOGETHER", 8)
    units = alignment.Units(alignment.tokenizers_of(A, B))
    texts = [units.of_text(t) for t in ("one two three", None, "a ▁ b", "one  ", "two")]
    flat, ends = alignment.aligned_texts(units, texts)
    assert list(ends) == [0, 3, 3, 3, 4, 5] and list(flat) == [0, 1, 2, units["one  "] if "one  " in units else flat[3], 1]
    assert len(units.groups) == len(units.valid) == len(units) and (~units.valid).sum() == 1
    assert len(units.links) == units.sizes[3].sum()
    units.clear()
    assert units.of_text("two") == [0] and alignment.aligned_texts(units, [[0]])[0].tolist() == [0]


def test_perfect_hash_is_minimal_and_knows_its_keys(tmp_path):
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 47, n))
        shard = alignment.Shard.of(keys)
        assert sorted(shard.index(keys)) == list(range(len(keys)))
        with pytest.raises(KeyError):
            shard.index(np.setdiff1d(np.arange(5) + (1 << 50), keys))
        shard.counts = shard.keys * 2
        again = alignment.Shard.read(str(tmp_path), shard.write(str(tmp_path)))
        assert (again.counts[again.index(keys)] == keys * 2).all()


def test_names_of_units_spell_the_text():
    """A worker looks units up by name, without the space that nearly all begin with; two units never share a name."""
    known, names = alignment.tokenizers_of(A, B), {}
    for text in ("one two", "one\ntwo", "one \ntwo", "\none", " one", "one  two", "one ", " ", "\n", " \n x", "a\t\tb c", "\tx", "x\n\n y",
                 *(row[1] for row in odd_rows() if row[1])):
        units = known.units(text)
        assert "".join(map(known.spelled, units)) == " " + text
        for name in units:
            assert names.setdefault(known.spelled(name), name) == name and known.name(known.spelled(name)) == name
    assert known.units("one\ntwo three") == ["one", "\ntwo", "three"]
