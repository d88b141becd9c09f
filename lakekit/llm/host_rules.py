"""Quality rules judged by host, in SQL functions only.

Every document is measured whole; rules on these measures fail or pass it.  Failures are
summed by host, each host's failure rates are shrunk towards all hosts' by a beta prior
fitted to the hosts (moments), and the verdict on a host goes back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import staged

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 5                  # words in a repeated window
LEAST_WORDS = 10
HOST_RATE = 0.5             # a host goes when a rule's shrunk failure rate is above this
PRIOR_RANGE = (1.0, 1e6)    # weight of the prior, in documents


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the
    whole text (NULL: none).

    Windows are compared by 64-bit hashes of their words.  Only texts in which a hash comes
    twice (an array and its distinct values differ in size) go on to sort hashes.
    """
    keep = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = lambda c: F.btrim(c, F.lit(BLANKS)) == ""
    df = docs.select(
        *keep, text.alias("_text"),
        F.when(blank(text), F.array().cast("array<string>")).otherwise(F.split(F.btrim(text, F.lit(BLANKS)), BLANK_RUN)).alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: ~blank(line)).alias("_lines"))
    n = F.size("_words")
    w = F.col("_words")
    df = df.select(
        *keep, n.cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", r"[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(w[i + k] for k in range(WINDOW))))).alias("_windows"))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   F.when(again, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"))
    s, last = F.col("_sorted"), F.size("_sorted") - 1
    twice = F.filter("_sorted", lambda x, j: F.when(j > 0, s[j - 1]["h"] == x["h"]).otherwise(False)
                     | F.when(j < last, s[j + 1]["h"] == x["h"]).otherwise(False))
    # windows that come again, by place: each covers the words that the one before doesn't
    covered = F.aggregate(F.sort_array(F.transform(twice, lambda x: x["i"])), F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
                          lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["at"])).alias("n")))
    return df.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     F.when(F.col("_sorted").isNull(), F.lit(0)).otherwise(covered["n"]).cast("long").alias("n_repeat_words"))


def base_rules() -> dict[str, Column]:
    c = F.col
    return {"short": c("n_words") < LEAST_WORDS, "repeats": 100 * c("n_repeat_words") > 20 * c("n_words")}


def host_rules() -> dict[str, Column]:
    """The base rules and looser signs of a bad host."""
    c = F.col
    return base_rules() | {"symbols": 10 * c("n_symbols") > c("word_chars"), "same_lines": 5 * c("n_dup_lines") > c("n_words"),
                           "long_words": c("word_chars") > 15 * c("n_words")}


def rejected_hosts(measured: DataFrame, host_col: str = "source", rate: float = HOST_RATE) -> DataFrame:
    """Hosts (one column) of which a rule's shrunk failure rate is above ``rate``.

    Documents without a host are in none.  One row of sums over all hosts goes to the driver.
    """
    rules = host_rules()
    hosts = (measured.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("_host"))
             .agg(F.count("*").alias("_n"), *(F.sum(F.when(r, 1).otherwise(0)).alias(k) for k, r in rules.items())))
    total = hosts.agg(F.count("*").alias("_hosts"), F.sum("_n").alias("_n"), F.sum(1 / F.col("_n")).alias("_inverse"),
                      *(F.sum(k).alias(k) for k in rules), *(F.sum(F.col(k) * F.col(k) / F.col("_n") / F.col("_n")).alias(f"{k}_2") for k in rules),
                      *(F.sum(F.col(k) / F.col("_n")).alias(f"{k}_1") for k in rules)).first()
    bad = F.lit(False)
    for k in rules:
        mean, weight = beta_prior(total["_hosts"], total["_inverse"], total[k], total["_n"], total[f"{k}_1"], total[f"{k}_2"])
        bad = bad | ((F.col(k) + mean * weight) / (F.col("_n") + weight) > rate)
    return hosts.where(bad).select("_host")


def beta_prior(hosts, inverse, failures, docs, rates, squares) -> tuple[float, float]:
    """(mean, weight) of the beta distribution of hosts' failure rates, by moments: what the
    spread of rates exceeds that of equal hosts by is the hosts' own."""
    if not docs:
        return 0.0, PRIOR_RANGE[0]
    mean = failures / docs
    spread = squares / hosts - (rates / hosts) ** 2 - mean * (1 - mean) * inverse / hosts
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR_RANGE[1]
    return mean, min(max(weight, PRIOR_RANGE[0]), PRIOR_RANGE[1])


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """id, the five measures, base_failed, kept: one row per input row.

    A NULL text has no words and fails; a NULL host is judged by its own text alone; repeated
    rows count each; an empty table gives no rows; other columns are left out.  The measures
    are written once, then read for the hosts and for the result; hosts that go are few or
    many, so the join is left to Spark (a hot host's rows are split as a skewed partition).
    """
    rows = docs.select(F.col(id_col), F.col(host_col).alias("_host"), F.col(text_col).alias("_of"))
    base = base_rules()
    measured = staged(with_measures(rows, "_of").drop("_of").withColumn("base_failed", base["short"] | base["repeats"]), "host-measures")
    bad = rejected_hosts(measured, "_host").withColumn("_bad", F.lit(True))
    return measured.join(bad, "_host", "left").withColumn("kept", ~F.col("base_failed") & F.col("_bad").isNull()).drop("_host", "_bad")
