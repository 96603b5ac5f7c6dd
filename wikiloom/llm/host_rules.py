"""Quality rules by document, and verdicts on whole hosts.

Rule failures are counted per host. The failure rates of all hosts give a beta
prior per rule (method of moments); a host's rate is shrunk by it, so a host
with few documents stays near the corpus, however bad they are. A host is
rejected if its rate is high beyond doubt: two standard deviations of its
posterior below the mean still lie above ``max_rate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.shared import stored

SYMBOLS = b"#*$%&|<>"
#: Rule name to its condition on the base columns.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "same_lines": "3 * n_dup_lines > n_lines",
}
BASE_RULES = ("short", "repeats")
MAX_RATE = 0.8
#: Strength of the prior where hosts do not differ more than chance, and its least.
STRONGEST, WEAKEST = 1e6, 2.0
#: Rejected hosts that are broadcast, and parts of a host where there are more.
MOST_BROADCAST, SALTS = 10_000, 64


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    repeated = times[which] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift:n - 2 + shift] |= repeated
    return int(inside.sum())


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; all 0 for a null text."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    chars = len(b"".join(words).decode(errors="replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def counts_of(text: Column) -> Column:
    """The base columns of each text, as a struct."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in texts:
            table = [base_counts(None if t is None else t.encode(errors="replace")) for t in column]
            yield pd.DataFrame(table, columns=list(COUNTS), dtype="int64")

    return counts(text.cast("string"))


def with_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, source`` and the base columns, one row per row of ``docs``."""
    return docs.select("doc_id", "source", counts_of(F.col("text")).alias("_counts")).select(
        "doc_id", "source", "_counts.*")


def host_verdicts(counted: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``source``, its documents, the shrunk failure rate of each rule, and ``host_rejected``."""
    fails = counted.groupBy("source").agg(
        F.count("*").alias("n_docs"), *(F.count_if(F.expr(rule)).alias(f"fail_{name}") for name, rule in RULES.items()))
    moments = []
    for name in RULES:
        k, n = F.col(f"fail_{name}"), F.col("n_docs")
        mean = F.sum(k) / F.sum(n)
        # Between-host variance: what squared deviations leave beyond binomial chance.
        moments += [mean.alias(f"mean_{name}"), F.sum(k * k / n).alias(f"kk_{name}"), F.sum(k).alias(f"k_{name}")]
    prior = fails.agg(F.sum("n_docs").alias("total"), F.count("*").alias("n_hosts"),
                      F.sum(F.col("n_docs") * F.col("n_docs")).alias("squares"), *moments)
    hosts = fails.join(F.broadcast(prior))  # one row
    rejected = F.lit(False)
    for name in RULES:
        mean, chance = F.col(f"mean_{name}"), F.col(f"mean_{name}") * (1 - F.col(f"mean_{name}"))
        between = F.col(f"kk_{name}") - F.col("total") * mean * mean - (F.col("n_hosts") - 1) * chance
        weight = F.col("total") - F.col("squares") / F.col("total")
        variance = F.when(weight > 0, between / weight).otherwise(0.0)
        strength = F.when(variance > chance / STRONGEST, F.greatest(chance / variance - 1, F.lit(WEAKEST))).otherwise(STRONGEST)
        a = mean * strength + F.col(f"fail_{name}")
        whole = strength + F.col("n_docs")
        rate = a / whole
        spread = F.sqrt(rate * (1 - rate) / (whole + 1))
        hosts = hosts.withColumn(f"rate_{name}", rate)
        # A corpus that fails as a whole says nothing against one host: own failures must be as frequent.
        own = F.col(f"fail_{name}") / F.col("n_docs")
        rejected = rejected | ((rate - 2 * spread > max_rate) & (own > max_rate))
    return hosts.select("source", "n_docs", *(f"rate_{name}" for name in RULES), rejected.alias("host_rejected"))


def apply_rules(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``doc_id, source``, the base columns, ``base_failed, host_rejected, kept``; a row per row of ``docs``.

    Documents without text have no words and fail. A null ``source`` is a host
    of its own. An empty table gives no rows. Repeated rows each count. Host
    counts combine before the shuffle; a hot host is one row by then, and hosts
    are joined back with the optimiser's choice of join, which splits skew.
    """
    counted = stored(with_counts(docs), "counts")
    hosts = host_verdicts(counted, max_rate).select(F.col("source").alias("_host"), "host_rejected")
    failed = F.expr(" or ".join(RULES[name] for name in BASE_RULES))
    judged = counted.join(hosts, counted["source"].eqNullSafe(hosts["_host"]), "left").drop("_host")
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def keep_good(docs: DataFrame, max_rate: float = MAX_RATE, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The rows of ``docs`` that :func:`apply_rules` keeps, with their columns.

    Texts are counted once and stored beside their counts; hosts are judged
    from the counts alone. Up to ``most_broadcast`` rejected hosts are sent to
    all tasks, so texts stay where they are; more of them meet the rows by host
    and salt, which splits a hot host. Without rejected hosts nothing is joined.
    """
    counted = stored(docs.select(F.struct(*docs.columns).alias("_row"), counts_of(F.col("text")).alias("_counts")), "counted")
    hosts = host_verdicts(counted.select("_row.source", "_counts.*"), max_rate).where("host_rejected")
    bad = stored(hosts.select(F.col("source").alias("_host")), "rejected")
    failed = F.expr(" or ".join(RULES[name].replace("n_", "_counts.n_") for name in BASE_RULES))
    passed = counted.where(~failed).select("_row")
    n_bad, same = bad.count(), F.col("_row.source").eqNullSafe(F.col("_host"))
    if n_bad == 0:
        return passed.select("_row.*")
    if n_bad <= most_broadcast:
        return passed.join(F.broadcast(bad), same, "left_anti").select("_row.*")
    salted = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    part = F.pmod(F.xxhash64("_row.text"), F.lit(SALTS))
    return passed.join(salted, same & (part == F.col("_salt")), "left_anti").select("_row.*")
