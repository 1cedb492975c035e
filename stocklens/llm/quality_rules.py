"""Host-level quality rules.

Each text is measured once. A document fails outright on the base rules (too few words, mostly
repeated three-word windows). The advisory rules (symbols among words, repeated lines, odd mean
word length) are judged with the host the document came from: failures are counted by host, each
host's failure rate is shrunk toward an empirical beta prior fitted to all hosts, and the host's
verdict goes back to its documents.

* trusted (shrunk rate below ``suspect_rate``): one advisory failure is tolerated;
* suspect: a document that fails an advisory rule goes, others stay;
* rejected (shrunk rate of at least ``reject_rate``): all documents go.

Defined results: a null or empty text has no words and fails; a null host is a host of its own;
repeated rows are judged row by row; an empty table gives no rows and no hosts; only the named
text and host columns are read, other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, fresh, settle, table, text_column

METRICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
ADVISORY = ("fails_symbols", "fails_lines", "fails_word_length")


@dataclass(frozen=True)
class Rules:
    """Thresholds of the rules and of the host verdicts."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols_percent: int = 10
    max_dup_lines_percent: int = 30
    min_mean_chars: int = 3
    max_mean_chars: int = 12
    suspect_rate: float = 0.05
    reject_rate: float = 0.9


def repeated_windows(words: list[bytes]) -> int:
    """Words inside a three-word window that the text holds twice or more."""
    n = len(words)
    if n < 4:  # two windows need four words
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    base = len(codes)
    pairs = ids[:-1] * base + ids[1:]
    if base >= 1 << 20:  # keep the product below inside 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * base + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The METRICS of one UTF-8 text. Words end at ASCII white space only."""
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    points = int(np.count_nonzero((raw & 0xC0) != 0x80))
    blanks = len(text) - sum(map(len, words))
    symbols = sum(map(text.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    seen: set[bytes] = set()
    lines = dups = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    return len(words), points - blanks, symbols, lines, dups, repeated_windows(words)


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in METRICS]))
def metrics_of(texts: pa.Array) -> pa.Array:
    rows = [measure(t) for t in texts.cast(pa.binary()).to_pylist()]
    columns = np.array(rows, np.int64).reshape(-1, len(METRICS))
    return pa.StructArray.from_arrays(
        [pa.array(columns[:, i]) for i in range(len(METRICS))], list(METRICS)
    )


# Else a filter on the metrics moves below the projection that makes them: every text would be
# measured twice, by two Python workers at once in each task.
metrics_of = metrics_of.asNondeterministic()


def failures(m: Column, rules: Rules) -> dict[str, Column]:
    words = m["n_words"]
    return {
        "base_failed": (words < rules.min_words)
        | (m["n_repeat_words"] * 100 > words * rules.max_repeat_percent),
        "fails_symbols": m["n_symbols"] * 100 > words * rules.max_symbols_percent,
        "fails_lines": m["n_dup_lines"] * 100 > m["n_lines"] * rules.max_dup_lines_percent,
        "fails_word_length": (m["word_chars"] < words * rules.min_mean_chars)
        | (m["word_chars"] > words * rules.max_mean_chars),
    }


def host_key(name: str) -> Column:
    """Never null, so that documents without a host meet their verdict in the join."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("none"))


def host_verdicts(measured: DataFrame, rules: Rules) -> DataFrame:
    """One row for each host: host, n_docs, n_failed, shrunk_rate, verdict.

    ``measured`` has ``host`` and the failure columns. The prior's mean and variance are those of
    the hosts' own rates (method of moments); only that one row comes to the driver.
    """
    failed = F.col("base_failed")
    for rule in ADVISORY:
        failed = failed | F.col(rule)
    hosts = settle(
        measured.groupBy("host").agg(
            F.count("*").alias("n_docs"), F.sum(failed.cast("long")).alias("n_failed")
        ),
        "hosts",
    )
    rate = F.col("n_failed") / F.col("n_docs")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, var = mean or 0.0, var or 0.0
    strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e6) if var > 0 else 1e6
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn(
        "verdict",
        F.when(F.col("shrunk_rate") >= rules.reject_rate, "rejected")
        .when(F.col("shrunk_rate") >= rules.suspect_rate, "suspect")
        .otherwise("trusted"),
    )


def kept_by(verdict: Column, fails: list[Column]) -> Column:
    """The document's verdict, given its host's."""
    advisory = sum((f.cast("int") for f in fails[1:]), F.lit(0))
    tolerated = F.when(verdict == "trusted", 1).otherwise(0)
    return ~fails[0] & (verdict != "rejected") & (advisory <= tolerated)


def measured_documents(docs: DataFrame, rules: Rules, text: str, host: str, *keep: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    found = docs.select(
        *keep, host_key(host).alias("host"), metrics_of(text_column(docs, text)).alias("m")
    )
    fails = failures(F.col("m"), rules)
    return found.select(
        *keep, "host", *(F.col("m")[c].alias(c) for c in METRICS),
        *(f.alias(name) for name, f in fails.items()),
    )


def judge(
    docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text",
    host: str = "source",
) -> DataFrame:
    """Metrics, failures, host verdict and ``kept`` of every row, texts left out."""
    measured = settle(measured_documents(docs, rules, text, host, key), "measured")
    verdicts = settle(host_verdicts(measured, rules), "verdicts").select(
        "host", "shrunk_rate", "verdict"
    )
    fails = [F.col(c) for c in ("base_failed", *ADVISORY)]
    return measured.join(verdicts, "host").withColumn("kept", kept_by(F.col("verdict"), fails))


def keep_documents(
    docs: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source"
) -> DataFrame:
    """The rows that stay, with the columns they came with. Texts are measured in the pass that
    filters as well, so no text goes through a shuffle."""
    verdicts = settle(host_verdicts(measured_documents(docs, rules, text, host), rules), "verdicts")
    name, own = fresh(docs, "host_key__"), fresh(docs, "metrics__")
    fails = list(failures(F.col(own), rules).values())
    found = docs.withColumn(name, host_key(host)).withColumn(own, metrics_of(text_column(docs, text)))
    right = verdicts.select(F.col("host").alias(name), F.col("verdict").alias(fresh(docs, "verdict__")))
    return (
        found.join(right, name)
        .where(kept_by(F.col(right.columns[1]), fails))
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )


def op7_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "shrunk_rate", "verdict",
    )
