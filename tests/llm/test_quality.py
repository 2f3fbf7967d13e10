"""Host-level quality rules against counts and rates worked out row by row."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from ledgerspark.llm import quality
from tests.llm.conftest import SCHEMA, odd_rows, plain_words, words


def measures(text: str | None) -> tuple:
    text = text or ""
    found = plain_words(text)
    grams = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if plain_words(line)]
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered))


def failures(m: tuple) -> dict[str, bool]:
    n, chars, symbols, lines, dups, repeats = m
    return {"few_words": n < 50, "repeated_words": 100 * repeats > 50 * n, "odd_word_length": chars < 3 * n or chars > 10 * n,
            "symbols": 10 * symbols > n, "repeated_lines": 10 * dups > 3 * lines}


def expected_rates(rows: list[tuple]) -> dict:
    """Rates by host and rule, by the formula of moments."""
    hosts = defaultdict(list)
    for row in rows:
        hosts[row[3]].append(failures(measures(row[1])))
    total = len(rows)
    share = {h: len(found) / total for h, found in hosts.items()}
    chance = sum(w * (1 - w) / len(hosts[h]) for h, w in share.items())
    own = sum(w * (1 - w) * (1 - 1 / len(hosts[h])) for h, w in share.items())
    out = defaultdict(dict)
    for rule in quality.RULES:
        failed = {h: sum(f[rule] for f in found) for h, found in hosts.items()}
        m = sum(failed.values()) / total
        spread = sum(w * (failed[h] / len(hosts[h]) - m) ** 2 for h, w in share.items())
        apart = spread / (m * (1 - m)) - chance if 0 < m < 1 else 0
        for h, found in hosts.items():
            n = len(found)
            if apart <= 0:
                out[h][rule] = m
            elif apart >= own:
                out[h][rule] = failed[h] / n
            else:
                weight = 1 / (apart / own) - 1
                out[h][rule] = (failed[h] + m * weight) / (n + weight)
    return out


def expected(rows: list[tuple]) -> list[tuple]:
    bad = {h for h, rates in expected_rates(rows).items() if max(rates.values()) > quality.HOST_LIMIT}
    out = []
    for row in rows:
        m = measures(row[1])
        failed = failures(m)
        base = failed["few_words"] or failed["repeated_words"]
        out.append((row[0], row[3], *m, base, row[3] in bad, not base and row[3] not in bad))
    return sorted(out, key=str)


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def corpus() -> list[tuple]:
    """Good hosts, a large bad one, a bad one without a name, and a small one whose documents fail by chance."""
    rng = random.Random(8)
    rows = []
    for host, n, bad in [("good", 120, 0.02), ("fair", 60, 0.1), ("spam", 50, 0.9), (None, 40, 0.8), ("tiny", 1, 1.0), ("plain", 80, 0.05),
                         *((f"more {k}", 30, 0.04) for k in range(40))]:
        for i in range(n):
            text = words(rng, 80)
            if i < bad * n:
                text = " ".join("$ %" if k % 5 == 0 else w for k, w in enumerate(text.split()))
            rows.append((len(rows), text, "en", host, 1, -1, "x", 3, -7, 9, "y", "z", 0, 2, "n"))
    return rows


def test_odd_documents(odd):
    assert found(quality.quality_verdicts(odd)) == expected(odd_rows())


def test_bad_hosts_are_rejected_and_small_ones_shrunk(spark):
    rows = corpus()
    df = quality.quality_verdicts(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = found(df)
    assert got == expected(rows)
    assert {row[1] for row in got if row[9]} == {"spam", None}
    kept = Counter(row[1] for row in got if row[10])
    assert kept["good"] == 120 and kept["fair"] == 60 and kept["plain"] == 80 and "spam" not in kept
    raw = {h: f for h, f in expected_rates(rows).items()}
    assert 0.1 < raw["tiny"]["symbols"] < 1.0  # one failing document of one is no rate of 1


def test_rates_equal_those_of_moments(spark):
    rows = corpus()
    rates = quality.host_rates(quality.measured(spark.createDataFrame(rows, SCHEMA)))
    wanted = expected_rates(rows)
    for row in rates.collect():
        for rule in quality.RULES:
            assert row[f"rate_{rule}"] == pytest.approx(wanted[row.host][rule], rel=1e-9)


def test_repeats_ties_and_long_texts(spark):
    rng = random.Random(4)
    once = words(rng, 30_000, "abcdefghijklmnopqrstuvwxyz")
    texts = ["w " * 5_000, "a b a b a b c", "a b c d e a b c", once + " " + once, "x" * 50_000, "a\nb\na\n \n \nb\nA", "one two", "é$é # \x85   z", "#" * 70]
    rows = [(i, t, "en", "h", 1, -1, "x", 3, -7, 9, "y", "z", 0, 2, "n") for i, t in enumerate(texts)]
    got = {r.doc_id: tuple(r)[2:] for r in quality.measured(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: measures(t) for i, t in enumerate(texts)}


def test_no_documents_and_one_host(spark, empty):
    assert found(quality.quality_verdicts(empty)) == []
    rows = [row[:3] + ("one",) + row[4:] for row in corpus()]
    assert found(quality.quality_verdicts(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_plan_is_native(odd):
    plan = quality.measured(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
