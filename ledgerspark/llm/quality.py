"""Operator 12: quality rules of documents, and verdicts on whole hosts from rates shrunk by an empirical beta prior."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import WORD, Scratch

#: The six white-space characters that end words.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A host is rejected where more than this share of its documents, after shrinking, fails one rule.
HOST_LIMIT = 0.5

#: The rules that a document passes or fails: names and conditions over the columns of ``measured``.
RULES: dict[str, Callable[[], Column]] = {
    "few_words": lambda: F.col("n_words") < 50,
    "repeated_words": lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
    "odd_word_length": lambda: (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 10 * F.col("n_words")),
    "symbols": lambda: 10 * F.col("n_symbols") > F.col("n_words"),
    "repeated_lines": lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
}
#: A document that fails one of these is not kept, whatever its host.
BASE_RULES = ("few_words", "repeated_words")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measured(documents: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, and the MEASURES) of every row; a null text is empty, repeated rows are measured each.

    ``n_repeat_words`` counts the words that a three-word window covers whose words occur at least twice in the text.
    Windows that repeat are found by sorting the windows of a text next to each other, and only in texts that have one; the
    covered words are then added up from left to right. Texts are taken whole, and no row leaves its task.
    """
    text, words, grams = F.coalesce("text", F.lit("")), F.col("_words"), F.col("_grams")
    rows = documents.select("doc_id", F.col(host).alias("host"), text.alias("_text"), F.regexp_extract_all(text, F.lit(WORD), 0).alias("_words"),
                            F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0).alias("_lines"))
    rows = rows.withColumn("_grams", F.when(
        F.size(words) >= 3,
        F.transform(F.slice(words, F.lit(1), F.size(words) - 2), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)))))
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct(grams)) < F.size(grams), F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    ordered = F.col("_sorted")
    places = F.filter(F.transform(ordered, lambda x, k: F.when(
        ((k > 0) & F.get(ordered, k - 1)["g"].eqNullSafe(x["g"])) | F.get(ordered, k + 1)["g"].eqNullSafe(x["g"]), x["i"])), F.isnotnull)
    covered = F.aggregate(
        F.sort_array(places), F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda seen, i: F.struct(i.alias("last"), (seen["n"] + F.least(F.lit(3), i - seen["last"])).alias("n")), lambda seen: seen["n"])
    return rows.select(
        "doc_id", "host", F.size(words).cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def host_rates(rows: DataFrame, rules: dict[str, Callable[[], Column]] = RULES) -> DataFrame:
    """(host, n_docs, n_failed_<rule> and rate_<rule>) of each host; documents without one are a host together.

    The failures of a rule are held to be beta-binomial over the hosts. Mean m and correlation r of the prior are those of the
    moments of the hosts' rates p weighted by their documents n (w = n / N): the sum of w (p - m)^2 is expected to be
    m (1 - m) sum(w (1 - w) (1/n + r (1 - 1/n))). The prior weighs as many documents as 1/r - 1, so the rate of a host is
    (failures + m (1/r - 1)) / (n + 1/r - 1). Hosts that differ no more than by chance (r <= 0) all have the rate m.
    Documents are counted map-side; one row of moments reaches the driver.
    """
    hosts = rows.groupBy("host").agg(F.count("*").alias("n_docs"), *(F.count_if(make()).alias(f"n_failed_{name}") for name, make in rules.items()))
    total = hosts.agg(F.sum("n_docs").alias("n"), *(F.sum(f"n_failed_{name}").alias(name) for name in rules)).first()
    if not total["n"]:
        return hosts.withColumns({f"rate_{name}": F.lit(0.0) for name in rules})
    share, n = F.col("n_docs") / F.lit(total["n"]), F.col("n_docs")
    means = {name: total[name] / total["n"] for name in rules}
    spread = {name: F.sum(share * (F.col(f"n_failed_{name}") / n - F.lit(m)) * (F.col(f"n_failed_{name}") / n - F.lit(m))).alias(name) for name, m in means.items()}
    moments = hosts.agg(F.sum(share * (1 - share) / n).alias("chance"), F.sum(share * (1 - share) * (1 - 1 / n)).alias("own"), *spread.values()).first()
    rates = {}
    for name, m in means.items():
        apart = moments[name] / (m * (1 - m)) - moments["chance"] if 0 < m < 1 else 0.0
        failed = F.col(f"n_failed_{name}")
        if apart <= 0:
            rates[f"rate_{name}"] = F.lit(float(m))
        elif apart >= moments["own"]:
            rates[f"rate_{name}"] = failed / n
        else:
            weight = moments["own"] / apart - 1
            rates[f"rate_{name}"] = (failed + F.lit(m * weight)) / (n + F.lit(weight))
    return hosts.withColumns(rates)


def quality_verdicts(documents: DataFrame, host: str = "source", rules: dict[str, Callable[[], Column]] = RULES,
                     base: tuple[str, ...] = BASE_RULES, host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per document: doc_id, host, the MEASURES, base_failed, host_failed and kept.

    A document is kept if it passes the ``base`` rules and its host is not rejected: for no rule does the host's shrunk rate
    of failures exceed ``host_limit``. A host of few documents is thus judged by its like, not by chance. Only rejected
    hosts are joined back, by the host, and without texts, so a host with a third of all rows is a key that adaptive
    execution splits. Null text is empty (few words); rows without a host are a host together; repeated rows are
    judged each; an empty table gives no rows; no other column is read.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    rows = scratch.store("measured", measured(documents, host))
    rates = host_rates(rows, rules)
    too_high = [F.col(f"rate_{name}") > F.lit(host_limit) for name in rules]
    rejected = scratch.store("rejected", rates.where(F.greatest(*too_high) if len(too_high) > 1 else too_high[0])
                             .select(F.col("host").alias("_host"), F.lit(True).alias("_rejected")))
    failed = F.greatest(*(F.when(rules[name](), 1).otherwise(0) for name in base), F.lit(0)) > F.lit(0)
    judged = rows.join(rejected, F.col("host").eqNullSafe(F.col("_host")), "left")
    host_failed = F.col("_rejected").isNotNull()
    return judged.select("doc_id", "host", *MEASURES, failed.alias("base_failed"), host_failed.alias("host_failed"),
                         (~failed & ~host_failed).alias("kept"))


def op12_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return quality_verdicts(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    conditions = {
        "few_words": "n_words < 50",
        "repeated_words": "100 * n_repeat_words > 50 * n_words",
        "odd_word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
        "symbols": "10 * n_symbols > n_words",
        "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    }
    counts = ", ".join(f"count_if({c}) AS f_{name}" for name, c in conditions.items())
    totals = ", ".join(f"sum(f_{name}) / sum(n) AS m_{name}" for name in conditions)
    spreads = ", ".join(f"sum(n / total * (f_{name} / n - m_{name}) ** 2) AS s_{name}" for name in conditions)
    tests = " OR ".join(
        f"""CASE WHEN m_{name} IN (0, 1) OR s_{name} / nullif(m_{name} * (1 - m_{name}), 0) <= chance THEN m_{name}
             WHEN s_{name} / (m_{name} * (1 - m_{name})) - chance >= own THEN f_{name} / n
             ELSE (f_{name} + m_{name} * (own / (s_{name} / (m_{name} * (1 - m_{name})) - chance) - 1))
                  / (n + own / (s_{name} / (m_{name} * (1 - m_{name})) - chance) - 1) END > {HOST_LIMIT}"""
        for name in conditions)
    return rf"""
WITH rows_ AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM rows_)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT place) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY r),
measured AS (
  SELECT doc_id, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM rows_ LEFT JOIN covered USING (r)),
hosts AS (SELECT source, count(*) AS n, {counts} FROM measured GROUP BY source),
totals AS (SELECT sum(n) AS total, {totals} FROM hosts),
moments AS (SELECT sum(n / total * (1 - n / total) / n) AS chance, sum(n / total * (1 - n / total) * (1 - 1 / n)) AS own, {spreads} FROM hosts, totals),
rejected AS (SELECT source, true AS rejected FROM hosts, totals, moments WHERE {tests}),
judged AS (SELECT m.*, r.rejected IS NOT NULL AS host_failed, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
           FROM measured m LEFT JOIN rejected r ON m.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept FROM judged
"""


OP12_SQL = _sql()
