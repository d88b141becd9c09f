"""Language ID by string kernels.

The kernel of two texts is the share of character n-grams (lengths 1 to 3 blended) that
both contain, over hashed n-grams: |A and B| / sqrt(|A| |B|).  A bounded, stratified sample
of labelled texts is the training set, a part of it the Nystroem landmarks Z.  With
K_zz = U S U', a text's features are k(x, Z) U S^-1/2, on which one-versus-rest kernel ridge
regression is fitted.  k(x, Z) is a product of x's presence vector with Z's, so all that
follows it is one matrix: a batch of texts is scored by one sparse matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import focus, fold, staged

UNKNOWN = "und"
BITS = 17               # hashed n-gram space
LONGEST = 3             # n-grams of 1 to 3 characters
PER_LANGUAGE = 200      # training texts for each language at most
SAMPLE = 6000           # training texts in all at most (the sample's bound; at least one a language)
LANDMARKS = 60          # of them landmarks, for each language
ALL_LANDMARKS = 1500    # landmarks in all, if languages are many (at least one a language)
SPARE = 4               # ids looked at for each one that is learnt from
KERNEL_BLOCK = 64       # landmarks whose columns of the kernel are made together
RIDGE = 1e-2
SLICE = 1 << 20         # characters hashed at a time
HELD_OUT, FOLDS = 2, 4

# Fixed odd multipliers (fractions of the golden ratio and of square roots, in 32 bits).
_MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def presence(text: str, flags: np.ndarray) -> np.ndarray:
    """Sorted hashed n-grams of the whole text.  ``flags``: scratch, all False."""
    for at in range(0, max(1, len(text)), SLICE):
        codes = np.frombuffer(text[at: at + SLICE + LONGEST - 1].lower().encode("utf-32-le", "replace"), np.uint32)
        gram = np.zeros(len(codes), np.uint32)
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            gram = (gram[: len(codes) - n + 1] * _MIX[1] + codes[n - 1:] + np.uint32(n)) * _MIX[0]
            flags[(gram ^ (gram >> np.uint32(15))) * _MIX[2] >> np.uint32(32 - BITS)] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found.astype(np.int32)


class LanguageModel:
    """``weights`` [hashed n-grams, languages]: scores are presence @ weights / sqrt(size)."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    @classmethod
    def fit(cls, sample: list[tuple[str, np.ndarray]]) -> LanguageModel:
        languages = sorted({lang for lang, _ in sample})
        if not languages:
            return cls([], np.zeros((1 << BITS, 0), np.float32))
        each = max(1, min(LANDMARKS, ALL_LANDMARKS // len(languages)))
        seen: dict[str, int] = {}
        marks = []
        for i, (lang, _) in enumerate(sample):
            seen[lang] = seen.get(lang, 0) + 1
            if seen[lang] <= each:
                marks.append(i)
        kernel = cls._kernel(sample, marks)
        values, vectors = np.linalg.eigh(kernel[marks])
        keep = values > 1e-8 * values.max()
        to_features = vectors[:, keep] / np.sqrt(values[keep])
        features = kernel @ to_features
        target = np.where(np.array([[lang == l for l in languages] for lang, _ in sample]), 1.0, -1.0)
        share = np.array([seen[lang] for lang, _ in sample])[:, None]
        weighted = features / share         # each language weighs the same
        ridge = np.linalg.solve(features.T @ weighted + RIDGE * np.eye(features.shape[1]) * len(languages) / len(sample), weighted.T @ target)
        weights = np.zeros((1 << BITS, len(languages)), np.float32)
        for i, row in zip(marks, to_features @ ridge):      # a landmark's n-grams are distinct
            weights[sample[i][1]] += (row / np.sqrt(len(sample[i][1]))).astype(np.float32)
        return cls(languages, weights)

    @staticmethod
    def _kernel(sample: list[tuple[str, np.ndarray]], marks: list[int]) -> np.ndarray:
        """[texts, landmarks]: shared n-grams over the root of both numbers of n-grams.  Texts are
        lists of n-grams; only the columns of some landmarks at a time are spread out."""
        sizes = np.array([len(grams) for _, grams in sample])
        starts, flat = np.append(0, np.cumsum(sizes)), np.concatenate([grams for _, grams in sample])
        kernel = np.empty((len(sample), len(marks)))
        some = 1 << 16      # n-grams looked up at a time
        for at in range(0, len(marks), KERNEL_BLOCK):
            block = marks[at: at + KERNEL_BLOCK]
            columns = np.zeros((1 << BITS, len(block)), np.float32)
            for k, i in enumerate(block):
                columns[sample[i][1], k] = 1
            first = 0
            while first < len(sample):
                stop = max(first + 1, int(np.searchsorted(starts, starts[first] + some, side="right")) - 1)
                found = columns[flat[starts[first]: starts[stop]]]
                kernel[first:stop, at: at + len(block)] = np.add.reduceat(found, starts[first:stop] - starts[first], axis=0)
                first = stop
        return kernel / np.sqrt(np.outer(sizes, sizes[marks]))

    def score(self, grams: list[np.ndarray]) -> np.ndarray:
        """[texts, languages]; no text of the batch is without an n-gram."""
        starts = np.cumsum([0, *map(len, grams[:-1])])
        sums = np.add.reduceat(self.weights[np.concatenate(grams)], starts, axis=0, dtype=np.float64)
        return sums / np.sqrt([len(g) for g in grams])[:, None]


def language_sample(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = PER_LANGUAGE) -> list[tuple[str, np.ndarray]]:
    """Hashed n-grams of up to ``per_language`` labelled texts of each language, chosen by a
    hash of the id, and fewer of each when languages are so many that ``SAMPLE`` is reached.
    Ids are counted roughly first, so that a language's window holds a few times the sample,
    whatever the corpus.
    Of rows that share id and language one is learnt from: of those with a letter, the one
    whose text has the least hash."""
    rows = (docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
            .select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")).withColumn("_print", F.xxhash64("_text")))
    ids = staged(rows.groupBy("_lang").agg(F.approx_count_distinct("_id").alias("_ids")), "language-ids")
    per_language = max(1, min(per_language, SAMPLE // max(1, ids.count())))
    # of a language with many ids only those with a small hash go on: a few times what is learnt from
    order = F.pmod(F.xxhash64("_id"), F.lit(1 << 31))
    few = ids.select("_lang", (F.lit(float(SPARE * per_language * (1 << 31))) / F.col("_ids")).alias("_below"))
    near = rows.join(few, "_lang").where(order < F.col("_below")).select("_id", "_lang", "_print")
    first = Window.partitionBy("_lang").orderBy(order, "_id")
    chosen = (near.groupBy("_id", "_lang").agg(F.min("_print").alias("_print")).withColumn("_n", F.row_number().over(first))
              .where(F.col("_n") <= per_language).drop("_n"))  # at most per_language keys for each language
    texts = rows.join(F.broadcast(chosen), ["_id", "_lang", "_print"]).groupBy("_id", "_lang").agg(F.min("_text").alias("_text"))

    def grams(batches):
        focus()
        flags = np.zeros(1 << BITS, bool)
        for batch in batches:
            found = [presence(t, flags) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["_id", "_lang", "_grams"])

    learnt = texts.mapInArrow(grams, "_id string, _lang string, _grams array<int>").toArrow()
    got = sorted(zip(learnt["_id"].to_pylist(), learnt["_lang"].to_pylist(), (np.asarray(g.values) for g in learnt["_grams"])), key=lambda r: (r[0], r[1], len(r[2])))
    return [(lang, grams) for _, lang, grams in got if len(grams)]


def train_language_model(docs: DataFrame, learn: Column, **columns) -> LanguageModel:
    return LanguageModel.fit(language_sample(docs, learn, **columns))


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str = "text",
                     lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with two more columns: the best language and a score from 0 to 1.

    A text that is NULL or has no letter is ``und`` with score 0, as is every text when no
    labelled one was there to learn from.  Ties go to the language first in order.  One row
    per input row; the output names must not be among the columns.  Nothing is shuffled.
    """
    from pyspark.sql.types import StructType

    out = StructType([*docs.schema.fields]).add(lang_out, "string").add(score_out, "double")
    if len(set(out.names)) < len(out.names):
        raise ValueError("an output column's name is taken")
    at = docs.columns.index(text_col)

    def run(batches):
        focus()
        flags = np.zeros(1 << BITS, bool)
        for batch in batches:
            langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            texts = batch.column(at).to_pylist()
            rows = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model.languages else []
            for k in range(0, len(rows), 128):
                part = rows[k: k + 128]
                found = model.score([presence(texts[i], flags) for i in part])
                for i, best, value in zip(part, found.argmax(1), found.max(1)):
                    langs[i], scores[i] = model.languages[best], min(1.0, max(0.0, (value + 1) / 2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=out.names)

    return docs.mapInArrow(run, out)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows outside the held-out fold, predict all: id, held_out, lang_pred, score.

    A row with a NULL id is in no fold: held out and not learnt from.
    """
    remainder = fold(F.col(id_col), FOLDS)
    model = train_language_model(docs, remainder != HELD_OUT, id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.coalesce(remainder == HELD_OUT, F.lit(True)).alias("held_out"))
    return predict_language(rows, model, "_text").drop("_text")
