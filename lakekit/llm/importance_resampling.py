"""Importance resampling of documents towards a target distribution.

A document's features are its words and pairs of neighbouring words, hashed into buckets.
A bucket's gain is the log ratio of its smoothed shares in the target and in all documents;
a document's weight is the mean gain of its features.  Adding Gumbel noise and keeping the
highest scores draws documents without replacement, in proportion to their weight.

Texts are cut by Arrow kernels, a batch at a time: lower-cased, split, flattened, encoded as
a dictionary.  Shifted dictionary indices form the pairs; only distinct words and pairs are
hashed; gains are taken by bucket and summed over each document's segment.  The corpus is
read twice and never shuffled: each task hands on at most one count a bucket, then one row a
document.  The draw is a range exchange of these rows, ranked without a single partition.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import focus, staged
from lakekit.operators.keys import assign_surrogate_keys

BUCKETS = 10_000
LEAST_WORDS = 20        # shorter documents are never drawn
PERCENT = 25
SEED = 7
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"      # after A-Z became a-z


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, first feature of each text and the end, words of each text).

    A text's words come first, its pairs after them.  NULL counts as empty.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=BETWEEN_WORDS)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(flat, "")
    coded = flat.filter(full).dictionary_encode()
    word, owner = coded.indices.to_numpy().astype(np.int64), owner.filter(full).to_numpy()
    spelt = coded.dictionary.cast(pa.binary()).to_pylist()
    one = [zlib.crc32(w) for w in spelt]
    spaced = [zlib.crc32(b" ", c) for c in one]
    beside = owner[:-1] == owner[1:]
    pairs, pair = np.unique((word[:-1] * len(spelt) + word[1:])[beside], return_inverse=True)
    crc = zlib.crc32
    two = [crc(spelt[b], spaced[a]) for a, b in zip((pairs // max(1, len(spelt))).tolist(), (pairs % max(1, len(spelt))).tolist())]
    n_words = np.bincount(owner, minlength=len(texts))
    n_pairs = np.maximum(n_words - 1, 0)
    first = np.concatenate([[0], np.cumsum(n_words + n_pairs)])
    out = np.empty(first[-1], np.int64)
    pairs_before = np.concatenate([[0], np.cumsum(n_pairs)])[:-1]
    words_until = np.cumsum(n_words)
    out[np.arange(len(word)) + pairs_before[owner]] = np.array(one, np.int64)[word] % buckets if len(word) else 0
    out[np.arange(len(pair)) + words_until[owner[:-1][beside]]] = np.array(two, np.int64)[pair] % buckets if len(pair) else 0
    return out, first, n_words


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts by bucket; a task hands on one row a bucket at most."""
    def count(batches):
        focus()
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            n += np.bincount(features(batch.column(0), buckets)[0], minlength=buckets)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], names=["bucket", "n"])

    return docs.select(F.col(text_col)).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket in thousandths, rounded down; at most ``buckets`` rows of each side reach the driver."""
    source, wanted = np.zeros(buckets), np.zeros(buckets)
    for counts, of in ((source, docs), (wanted, target)):
        for r in bucket_counts(of, text_col, buckets).collect():
            counts[r["bucket"]] = r["n"]
    S, T = float(source.sum()), float(wanted.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) for s, t in zip(source.tolist(), wanted.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_features, weight: the mean of the features' gains, rounded down (0 without any)."""
    def run(batches):
        focus()
        for batch in batches:
            bucket, first, n_words = features(batch.column(1), len(gain))
            total = np.concatenate([[0], np.cumsum(gain.take(bucket))])
            n = np.diff(first)
            weight = np.diff(total[first]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(weight)], names=[id_col, "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """id, n_features, weight, score, rank of every document: rank 1, 2, 3... for the drawn
    ones by falling score, NULL for the others.

    Of the documents with at least ``least_words`` words ``percent`` of a hundred are drawn
    (rounded down), ties going to the smaller id.  Repeated rows are documents of their own;
    of equal scores and ids the one with fewer features comes first.  A NULL id hashes as an
    empty one and comes after all others in a tie; a NULL text is empty.  An empty table gives
    no rows, an empty target gains that only make up for the documents' own shares.  Other
    columns are left out.
    """
    u = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((u + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weigh(docs, gains(docs, target, text_col, buckets), id_col, text_col).withColumn("score", F.col("weight") + noise)
    # the tie splits rows that are alike over ranges; it is written, so a lost executor can't change it
    scored = staged(scored.withColumn("_tie", F.monotonically_increasing_id()), "resampling-scores")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    order = {"_low": -F.col("score"), "_none": F.col(id_col).isNull()}
    ranked = assign_surrogate_keys(scored.where(enough).withColumns(order), ["_low", "_none", id_col, "n_features", "_tie"], "rank")
    columns = [F.col(c) for c in (id_col, "n_features", "weight", "score")]
    return (ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
            .union(scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))))
