import math
import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from lakekit.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_presence_is_the_set_of_hashed_grams():
    flags = np.zeros(1 << li.BITS, bool)
    a = li.presence("abcab", flags)
    assert not flags.any()
    assert len(a) == len({"abcab"[i:i + n] for n in (1, 2, 3) for i in range(6 - n)})
    assert (li.presence("ABCAB", flags) == a).all()
    assert len(li.presence("", flags)) == 0


def test_slices_of_a_long_text_lose_no_gram(monkeypatch):
    flags = np.zeros(1 << li.BITS, bool)
    text = "".join(chr(97 + (i * i) % 26) for i in range(5000))
    whole = li.presence(text, flags)
    monkeypatch.setattr(li, "SLICE", 7)
    assert (li.presence(text, flags) == whole).all()


def test_scores_are_the_kernel_regression():
    """The folded weights score as the kernel with every landmark does."""
    flags = np.zeros(1 << li.BITS, bool)
    texts = [("x", f"aaa bab {'ab' * k}") for k in range(1, 9)] + [("y", f"zzz yzy {'zy' * k}") for k in range(1, 9)]
    sample = [(lang, li.presence(t, flags)) for lang, t in texts]
    model = li.LanguageModel.fit(sample)
    kernel = np.array([[len(np.intersect1d(a, b)) / math.sqrt(len(a) * len(b)) for _, b in sample] for _, a in sample])
    target = np.array([[1.0 if lang == l else -1.0 for l in "xy"] for lang, _ in sample])
    got = model.score([g for _, g in sample])
    # all texts are landmarks: kernel ridge regression in closed form
    want = kernel @ np.linalg.pinv(kernel @ kernel / 8 + li.RIDGE * 2 / 16 * kernel, rcond=1e-9) @ kernel @ target / 8
    assert np.abs(got - want).max() < 1e-2
    assert (got.argmax(1) == target.argmax(1)).all()


def test_held_out_accuracy_and_columns(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("x")).withColumn("_id", F.lit(1))
    rows = li.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert 200 < len(held) < 300
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in li.identify_languages(d).collect()} for d in (docs, other))
    assert a == b


def test_odd_texts(llm):
    good = [(i, "der die und ist nicht auch " * 3 if i % 2 else "the of and with that from " * 3, "de" if i % 2 else "en") for i in range(40)]
    rows = [*good, (100, None, "de"), (101, "", "en"), (102, "12 !? 34", "xx"), (None, "the and of", "en"), (103, "der und", None), (104, "the " * 50_000, "en"), (105, "é", "fr")]
    got = {r.doc_id: r for r in li.identify_languages(llm.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[103].lang_pred == "de" and got[104].lang_pred == "en" and got[None].lang_pred == "en" and got[None].held_out


def test_nothing_to_learn_from(llm):
    df = llm.createDataFrame([(1, "text", None), (1, "text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in li.identify_languages(df).collect()] == ["und", "und"]
    assert li.identify_languages(df.limit(0)).count() == 0


def test_repeated_ids_give_one_text_each(llm):
    """A hot id, and an id with a NULL and a letterless text besides a good one."""
    good = [(i, "der die und ist nicht auch " * 3 if i % 2 else "the of and with that from " * 3, "de" if i % 2 else "en") for i in range(40)]
    learnt = [i for i in range(40) if zlib.crc32(str(i).encode()) % li.FOLDS != li.HELD_OUT]
    odd = [(learnt[0], None, good[learnt[0]][2]), (learnt[0], "12", good[learnt[0]][2])]
    hot = [(learnt[1], f"{good[learnt[1]][1]} {k % 30}", good[learnt[1]][2]) for k in range(300)]
    docs = llm.createDataFrame([*good, *odd, *hot], "doc_id long, text string, lang string")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % li.FOLDS != li.HELD_OUT
    assert len(li.language_sample(docs, learn)) == len(learnt)
    assert len(li.language_sample(docs, learn, per_language=5)) == 10
    got = li.identify_languages(docs).collect()
    assert len(got) == 342 and sum(r.lang_pred == "und" for r in got) == 2


def dense_weights(sample):
    """The fit with the landmarks as one dense matrix."""
    languages = sorted({lang for lang, _ in sample})
    marks, seen = [], {}
    for i, (lang, _) in enumerate(sample):
        seen[lang] = seen.get(lang, 0) + 1
        if seen[lang] <= li.LANDMARKS:
            marks.append(i)
    z = np.zeros((1 << li.BITS, len(marks)))
    for k, i in enumerate(marks):
        z[sample[i][1], k] = 1 / np.sqrt(len(sample[i][1]))
    kernel = np.array([z[g].sum(0) / np.sqrt(len(g)) for _, g in sample])
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-8 * values.max()
    to_features = vectors[:, keep] / np.sqrt(values[keep])
    f = kernel @ to_features
    target = np.where([[lang == l for l in languages] for lang, _ in sample], 1.0, -1.0)
    w = f / np.array([seen[lang] for lang, _ in sample])[:, None]
    return z @ (to_features @ np.linalg.solve(f.T @ w + li.RIDGE * np.eye(f.shape[1]) * len(languages) / len(sample), w.T @ target))


def sample_of(rnd, languages, texts, size):
    return [(f"l{k:03d}", np.sort(rnd.choice(4000, size, replace=False) + 1000 * (k % 100)).astype(np.int32)) for k in range(languages) for _ in range(texts)]


def test_fit_equals_a_dense_one():
    sample = sample_of(np.random.default_rng(1), 3, 80, 150)
    got = li.LanguageModel.fit(sample).weights
    assert np.abs(got - dense_weights(sample)).max() < 1e-4


def test_a_hundred_languages_take_bounded_memory():
    sample = sample_of(np.random.default_rng(2), 100, 60, 400)
    tracemalloc.start()
    model = li.LanguageModel.fit(sample)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20 and len(model.languages) == 100
    right = [model.languages[int(model.score([g])[0].argmax())] == lang for lang, g in sample[::37]]
    assert np.mean(right) > 0.95


def test_sample_is_spread_over_few_ids_a_language(llm):
    """Many ids, one id with most rows, a language with few: up to the bound of each, chosen by hash."""
    rows = [(i, f"text of {i}", "big") for i in range(3000)] + [(7, "hot row", "big")] * 2000 + [(i, f"kleiner Text {i}", "few") for i in range(9)]
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    got = li.language_sample(df, F.lit(True), per_language=50)
    counts = {lang: sum(x == lang for x, _ in got) for lang in ("big", "few")}
    assert counts == {"big": 50, "few": 9}
