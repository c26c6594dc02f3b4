"""Host-level quality rules (operator 7).

Each document is measured and held against a few rules. Failures are then counted per host (the ``source`` of a
document), each host's failure rate is shrunk towards all hosts' rates by a beta prior fitted to them, and a host
whose shrunk rate of a rule is above a limit is rejected, with every document it has. Of other hosts those documents
are rejected that fail a rule themselves, where the bar of symbols, repeated lines and word length is tightened by the
host's shrunk rate of that rule: the rate is what is believed of a document before it is read.

Defined cases: a null text has no words; a null source is a host of its own; repeated rows each count and each get
a row; an empty table gives an empty result; columns beyond the needed ones are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.common import binary_list, map_slices, saved, table, whole_text

MIN_WORDS = 50
MOST_REPEATED_PCT = 50
# A host is rejected when a rule's shrunk failure rate exceeds this share.
HOST_LIMIT = 0.8
# Strength of the prior, in documents, where hosts differ no more than chance would have it.
STRONGEST_PRIOR = 1_000_000.0

_SYMBOLS = b"#*$%&|<>"
_MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, and words in repeated three-word windows of one text."""
    words = text.split()
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    duplicates = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = 0
    if len(seen) < len(windows):
        covered = 0  # positions up to here are counted
        for at, window in enumerate(windows):
            if seen[window] > 1:
                repeated += at + 3 - max(at, covered)
                covered = at + 3
    return len(words), chars, symbols, duplicates, repeated


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Add the five measures of each text; ``keep`` names the columns that stay, without the text unless listed."""
    names = [part.split()[0] for part in _MEASURES.split(", ")]

    def run(batch: pa.RecordBatch) -> dict:
        rows = [measure(text) for text in binary_list(batch.column("_text"))]
        return {name: pa.array([row[i] for row in rows], pa.int64()) for i, name in enumerate(names)}

    frame = docs.select(*keep, whole_text().alias("_text"))
    return map_slices(frame, "_text", _MEASURES, run, keep)


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PCT)


def rules() -> dict[str, Column]:
    """Rules whose failures are counted per host."""
    words = F.col("n_words")
    return {
        "few_words": words < MIN_WORDS,
        "repetitive": F.col("n_repeat_words") * 100 > words * MOST_REPEATED_PCT,
        "symbols": F.col("n_symbols") * 10 > words,
        "duplicate_lines": F.col("n_dup_lines") * 10 > words,
        "word_length": (F.col("word_chars") < words * 2) | (F.col("word_chars") > words * 12),
    }


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """Per host: documents, and failures of each rule."""
    return measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(rule.cast("bigint")).alias(f"fail_{name}") for name, rule in rules().items()],
    )


def host_verdicts(rates: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Per host: whether a rule's shrunk failure rate is above the limit, and the largest such rate.

    The prior of a rule has the mean and the variance of the hosts' rates (method of moments). Its strength is
    ``mean * (1 - mean) / variance - 1`` documents; hosts without any variance have the strongest prior, and rates
    that differ more than any beta distribution has none, so such rates stay as counted.
    """
    names = list(rules())
    rate = {name: F.col(f"fail_{name}") / F.col("n_docs") for name in names}
    moments = rates.agg(*[
        made for name in names for made in (F.avg(rate[name]).alias(f"m_{name}"), F.var_pop(rate[name]).alias(f"v_{name}"))
    ])

    def shrunk(name: str) -> Column:
        mean, variance = F.col(f"m_{name}"), F.col(f"v_{name}")
        strength = F.when(
            variance > 0, F.greatest(F.lit(0.0), F.least(F.lit(STRONGEST_PRIOR), mean * (1 - mean) / variance - 1))
        ).otherwise(F.lit(STRONGEST_PRIOR))
        return (F.col(f"fail_{name}") + mean * strength) / (F.col("n_docs") + strength)

    # one row of moments, broadcast as a single row
    worst = F.greatest(*[shrunk(name) for name in names])
    joined = rates.join(F.broadcast(moments), F.lit(True))
    return joined.select(
        host, worst.alias("host_rate"), (worst > limit).alias("host_rejected"),
        *[shrunk(name).alias(f"rate_{name}") for name in names],
    )


def document_failed() -> Column:
    """Whether a document fails a rule itself; ``1 - rate`` of its host scales the bars of the rules beyond the base."""
    words = F.col("n_words")

    def slack(name: str) -> Column:
        return F.lit(1.0) - F.least(F.lit(1.0), F.col(f"rate_{name}"))

    long = slack("word_length")
    return (
        base_failed()
        | (F.col("n_symbols") * 10 > words * slack("symbols"))
        | (F.col("n_dup_lines") * 10 > words * slack("duplicate_lines"))
        | (F.col("word_chars") * long < words * 2)
        | (F.col("word_chars") > words * 12 * long)
    )


def judge(measured: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Join host verdicts back to measured documents as ``base_failed``, ``host_rejected`` and ``kept``.

    A document is kept that fails no rule itself, by bars that its host's shrunk rates tighten, and whose host isn't
    rejected.
    """
    other = verdicts.withColumnRenamed(host, "_host")
    joined = measured.join(other, measured[host].eqNullSafe(other["_host"]), "left").drop("_host")
    kept = ~document_failed() & ~F.col("host_rejected")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", F.coalesce(kept, F.lit(False)))


def quality(docs: DataFrame) -> DataFrame:
    """Measures and verdicts of every document, without its text."""
    measured = saved(measures(docs, ["doc_id", "source"]), "quality-measures")
    verdicts = saved(host_verdicts(host_rates(measured)), "quality-hosts")
    return judge(measured, verdicts)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    narrow = measures(docs, ["doc_id", "source"])
    verdicts = saved(host_verdicts(host_rates(narrow)), "quality-hosts")
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "source", "text")
    good = judge(measures(kept, ["_row", "source"]), verdicts).where("kept")
    return good.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_rejected",
    )


_WORD = r"[^\x20\x09-\x0D]+"
_RULE_SQL = {
    "few_words": "n_words < 50",
    "repetitive": "n_repeat_words * 100 > n_words * 50",
    "symbols": "n_symbols * 10 > n_words",
    "duplicate_lines": "n_dup_lines * 10 > n_words",
    "word_length": "word_chars < n_words * 2 OR word_chars > n_words * 12",
}


def measured_sql(source: str = "documents") -> str:
    """Common table expressions up to ``judged`` over the rows of ``source``."""
    fails = ", ".join(f"sum(CASE WHEN {sql} THEN 1 ELSE 0 END) AS f_{n}" for n, sql in _RULE_SQL.items())
    moments = ", ".join(f"avg(f_{n} / n_docs) AS m_{n}, var_pop(f_{n} / n_docs) AS v_{n}" for n in _RULE_SQL)
    strength = {
        n: f"CASE WHEN v_{n} > 0 THEN greatest(0.0, least(1000000.0, m_{n} * (1 - m_{n}) / v_{n} - 1)) ELSE 1000000.0 END"
        for n in _RULE_SQL
    }
    rate = {n: f"(f_{n} + m_{n} * ({strength[n]})) / (n_docs + ({strength[n]}))" for n in _RULE_SQL}
    worst = ", ".join(rate.values())
    slacks = ", ".join(f"1.0 - least(1.0, {rate[n]}) AS s_{n}" for n in ("symbols", "duplicate_lines", "word_length"))
    return rf"""
    given AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM {source}),
    split AS MATERIALIZED (SELECT rid, regexp_extract_all(text, '{_WORD}') AS words FROM given),
    spread AS (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3),
    windows AS (SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM spread),
    found AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows),
    repeated AS (
        SELECT rid, count(DISTINCT pos) AS n_repeat_words
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM found WHERE n > 1) GROUP BY rid),
    lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM given),
    dups AS (
        SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
        WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
    measured AS MATERIALIZED (
        SELECT doc_id, source, len(words) AS n_words,
            len(array_to_string(words, '')) AS word_chars,
            len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM given JOIN split USING (rid) LEFT JOIN repeated USING (rid) LEFT JOIN dups USING (rid)),
    hosts AS (SELECT source, count(*) AS n_docs, {fails} FROM measured GROUP BY source),
    moments AS (SELECT {moments} FROM hosts),
    verdicts AS (SELECT source, greatest({worst}) > {HOST_LIMIT} AS host_rejected, {slacks} FROM hosts, moments),
    judged AS (
        SELECT m.*, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed, host_rejected,
            n_symbols * 10 > n_words * s_symbols OR n_dup_lines * 10 > n_words * s_duplicate_lines
            OR word_chars * s_word_length < n_words * 2 OR word_chars > n_words * 12 * s_word_length AS own_failed
        FROM measured m JOIN verdicts v ON m.source IS NOT DISTINCT FROM v.source)"""


OP7_SQL = f"""
WITH {measured_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT own_failed AND NOT host_rejected AS kept, host_rejected
FROM judged"""
