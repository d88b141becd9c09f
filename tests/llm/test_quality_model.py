import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from lakekit.llm import quality_model as qm

SF = "/root/testdata/sf0.01"


def test_rules_find_a_conjunction_and_lasso_keeps_few():
    rnd = np.random.default_rng(1)
    x = rnd.random((1500, 6))
    y = ((x[:, 1] > 0.6) & (x[:, 4] <= 0.5)).astype(float)
    intercept, rules = qm.fit_rules(x, y)
    margin = intercept + sum(w * qm._holds(x, r) for w, r in rules)
    assert np.mean((margin > 0) == (y > 0)) > 0.97
    assert 0 < len(rules) < 60


def test_compiled_column_equals_the_fitted_score(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    intercept, rules, names = qm.train_quality(docs, llm.read.parquet(f"{SF}/labels.parquet"))
    stats, _ = qm.with_statistics(docs)
    for r in stats.select(*names, qm.rule_score(intercept, rules, names).alias("s")).limit(200).collect():
        x = np.array([[r[n] for n in names]])
        margin = intercept + sum(w * qm._holds(x, rule)[0] for w, rule in rules)
        assert abs(r["s"] - 1 / (1 + math.exp(-min(qm.CLIP, max(-qm.CLIP, margin))))) < 1e-12


def test_held_out_accuracy_and_columns(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("predicted", F.lit("x"))
    labels = llm.read.parquet(f"{SF}/labels.parquet")
    rows = qm.classify_quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_labels_and_other_columns_do_not_matter(llm):
    docs, labels = llm.read.parquet(f"{SF}/documents.parquet"), llm.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in qm.classify_quality(docs, labels).collect()}
    b = {r.doc_id: r.score for r in qm.classify_quality(docs.withColumn("lang", F.lit("q")), other).collect()}
    assert a == b


def test_odd_rows_and_empty_tables(llm):
    docs = llm.createDataFrame([(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "x" * 200_000), (4, "x" * 200_000)], "doc_id long, text string")
    labels = llm.createDataFrame([(1, 0), (1, 1), (2, None), (3, 1), (None, 1)], "doc_id long, quality int")
    rows = qm.classify_quality(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in qm.classify_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert qm.classify_quality(docs.limit(0), labels).count() == 0


def test_rows_that_share_an_id_are_learnt_from_once(llm):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % qm.FOLDS != qm.HELD_OUT]
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], f"other {k}") for k in range(200)] + [(ids[1], None)]
    labels = llm.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    x, y, names = qm.training_rows(docs, labels, sample=20)
    assert len(x) == len(y) == 20
    assert (qm.training_rows(docs.orderBy(F.desc("text")), labels, sample=20)[0] == x).all()
    assert len(qm.training_rows(docs, labels)[0]) == len(ids)
