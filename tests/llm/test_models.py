import zlib

import numpy as np

from tidewater.llm import language_crf, quality_nbsvm
from tidewater.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"


def out_fold(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op2_language_crf"](spark, MID).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang) and all(r.held_out == out_fold(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in tested) / len(tested) > 0.97


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    e, t = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    alpha, beta, _ = language_crf.forward_backward(np.concatenate([e, np.zeros((1, 4, 3))]), np.array([4, 2]), t)
    post = alpha[0] * beta[0]
    post /= post.sum(axis=1, keepdims=True)
    want = np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        p = np.exp(sum(e[0, i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        for i, y in enumerate(path):
            want[i, y] += p
    assert np.allclose(post, want / want.sum(axis=1, keepdims=True))


def test_segments_of_a_text_are_one_chain(monkeypatch):
    """Probabilities do not depend on where a text is cut into segments."""
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(40)]
    crf = language_crf.Crf(["a", "b", "c"], rng.normal(size=(language_crf.FEATURES, 3)).astype(np.float32) * 0.2, rng.normal(size=(3, 3)), {})
    texts = [[words[i] for i in rng.integers(0, 40, n)] for n in (0, 1, 5, 6, 7, 61, 200)]
    whole = []
    for size in (1000, 64, 6, 1):
        monkeypatch.setattr(language_crf, "SEGMENT", size)
        whole.append(language_crf.Labeller(crf).posteriors(texts))
    for other in whole[1:]:
        for x, y in zip(whole[0], other):
            assert x.shape == y.shape and np.allclose(x, y, atol=2e-4)


def test_words_are_letters_and_all_of_them():
    assert language_crf.words_of("½ ² Ⅷ 12 ٣ _") == [] and language_crf.words_of("x² Ⅷa 9é") == ["x", "a", "é"]
    run = "".join(chr(0x4E00 + i) for i in range(1000))
    assert "".join(language_crf.words_of(run)) == run and max(map(len, language_crf.words_of(run))) == 40
    crf = language_crf.Crf(["a"], np.zeros((language_crf.FEATURES, 1), np.float32), np.zeros((1, 1)), {})
    long = ["x" * 20 + c + "y" * 19 for c in "ab"]
    assert crf.features(long[0]) != crf.features(long[1])


def test_the_shape_of_a_whole_token_counts():
    assert quality_nbsvm._shape("ab1-" * 15) != quality_nbsvm._shape("ab1-" * 14 + "zz99")


def test_code_switched_words_and_traps(spark, docs_of, trap_docs):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    segments = language_crf.training_segments(docs, "doc_id", "text", "lang")
    crf = language_crf.train(segments)
    de, fr = " ".join(segments["de"][0][:20]), " ".join(segments["fr"][0][:20])
    mixed = language_crf.predict(docs_of([(1, f"{de} {fr}"), (2, None), (3, " 12 !?"), (4, "")]), crf, spans=True).collect()
    by = {r.doc_id: r for r in mixed}
    assert [s.label for s in by[1].spans][0] == "de" and [s.label for s in by[1].spans][-1] == "fr"
    assert sum(s.n_words for s in by[1].spans) == 40 and len(by[1].spans) <= 6
    assert all((by[i].lang_pred, by[i].score, by[i].spans) == ("und", 0.0, []) for i in (2, 3, 4))
    out = language_crf.language_id(trap_docs.withColumn("score", trap_docs.doc_id)).collect()
    got = sorted(((r.doc_id or 0, r.held_out, r.lang_pred, r.score > 0) for r in out))
    letterless = {2, 3, 7}
    assert got == sorted((i or 0, i is not None and out_fold(i), "und" if i in letterless else "en", i not in letterless)
                         for i in (1, 2, 3, 4, 5, 6, None, 7, 8, 9, 9, 10))
    none = language_crf.language_id(docs_of([(1, "½ ²"), (2, "Ⅷ")]).unionByName(docs)).filter("doc_id < 3 and score = 0").collect()
    assert [r.lang_pred for r in none] == ["und", "und"]
    assert language_crf.language_id(trap_docs.limit(0)).count() == 0


def test_quality_held_out_accuracy(spark):
    rows = QUERIES["op3_quality_nbsvm"](spark, MID).collect()
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    assert all(r.held_out == out_fold(r.doc_id) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    tested = [(r.score, r.predicted, known[r.doc_id]) for r in rows if r.held_out and known.get(r.doc_id) is not None]
    assert sum(p == y for _, p, y in tested) / len(tested) > 0.93
    good, bad = [s for s, _, y in tested if y], [s for s, _, y in tested if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_training_takes_whole_texts_up_to_a_bound(spark, docs_of, monkeypatch):
    ids = [i for i in range(60) if not out_fold(i)]
    text = lambda i, n: " ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{'x' * (j // 26 % 7)}" for j in range(n))
    rows = [(i, text(i, 3000 if n == 0 else 100 + n), "a" if n % 2 else "b") for n, i in enumerate(ids)]
    rows += [(1001, text(1, 5000), "c"), (1002, None, "c"), (1004, "", "c")]
    docs = spark.createDataFrame([r for r in rows if not out_fold(r[0])], "doc_id bigint, text string, lang string")
    held = {lang: sorted(w for _, t, x in rows for w in language_crf.words_of(t or "") if x == lang) for lang in "abc"}
    flat = lambda found: {lang: sorted(w for s in segments for w in s) for lang, segments in found.items()}
    whole = language_crf.training_segments(docs, "doc_id", "text", "lang")
    assert flat(whole) == {lang: ws for lang, ws in held.items() if ws and lang in whole}
    assert all(len(s) <= language_crf.SEGMENT for found in whole.values() for s in found)
    monkeypatch.setattr(language_crf, "TRAIN_CHARS", 2000)
    monkeypatch.setattr(language_crf, "TRAIN_SHORT", 1500)
    some = flat(language_crf.training_segments(docs, "doc_id", "text", "lang"))
    longest = {lang: max(len(t) for _, t, x in rows if x == lang and len(t or "") <= 1500) for lang in "ab"}
    for lang in "ab":  # short texts first, whole ones, past the bound by no more than the last
        size = sum(len(w) + 1 for w in some[lang])
        assert 2000 <= size <= 2000 + longest[lang] + 10
    assert set(some) == set(whole)  # a language whose first text passes the bound keeps that text


def test_packed_features_are_bounded_and_come_back():
    rng = np.random.default_rng(4)
    for n in (0, 1, 500, 8191, 8192, 50_000, quality_nbsvm.FEATURES):
        found = np.sort(rng.choice(quality_nbsvm.FEATURES, n, replace=False))
        data = quality_nbsvm.packed(found)
        assert len(data) <= quality_nbsvm.FEATURES // 8 and np.array_equal(quality_nbsvm.unpacked(data), found)
    rows = [np.sort(rng.choice(3000, 9000 if i % 7 == 0 else 40, replace=i % 7 == 0)) for i in range(50)]
    rows = [np.unique(r) for r in rows]
    labels = [int(r.mean() > 1500) for r in rows]
    kept = [quality_nbsvm.packed(r) for r in rows]
    made = quality_nbsvm.train(quality_nbsvm.Made(50, lambda i: quality_nbsvm.unpacked(kept[i])), labels)
    plain = quality_nbsvm.train(rows, labels)
    assert np.array_equal(made.scaled, plain.scaled) and (made.bias, made.slope, made.shift) == (plain.bias, plain.slope, plain.shift)


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(20, 6, replace=False)) for _ in range(60)]
    values = [rng.normal(size=6) for _ in rows]
    y = np.where([v.sum() + rng.normal() > 0 for v in values], 1, -1)
    w, b = quality_nbsvm.dual_descent(rows, values, y, epochs=400)
    loss = lambda w, b: 0.5 * (w @ w + b * b) + sum(max(0, 1 - y[i] * (w[rows[i]] @ values[i] + b)) for i in range(60))
    best = loss(w, b)
    for _ in range(300):
        assert best <= loss(w + 0.01 * rng.normal(size=w.shape) * (np.arange(len(w)) < 20), b + 0.01 * rng.normal()) + 1e-3


def test_quality_traps(spark, trap_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 1), (9, None), (None, 1), (1, 1)], "doc_id bigint, quality int")
    out = quality_nbsvm.quality(trap_docs.withColumn("label", trap_docs.doc_id), labels)
    assert out.count() == trap_docs.count()
    assert quality_nbsvm.quality(trap_docs, labels.limit(0)).count() == trap_docs.count()
    assert quality_nbsvm.quality(trap_docs.limit(0), labels).count() == 0


def test_training_ids_are_the_lowest_hashes_once_each(spark):
    from pyspark.sql import functions as F

    from tidewater.llm.common import lowest_ids
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("by"))
    many = rows.union(rows.filter("id = 9").crossJoin(spark.range(2000).select()))  # an id held by a quarter of the rows
    got = {(r.by, r.id) for r in lowest_ids(many, "by", 50).collect()}
    place = F.shiftrightunsigned(F.xxhash64("id"), 11)
    ranked = sorted((r.by, r.place, r.id) for r in rows.withColumn("place", place).collect())
    want = {(b, i) for name in "ab" for b, _, i in [r for r in ranked if r[0] == name][:50]}
    assert got == want and lowest_ids(many.limit(0), "by", 50).count() == 0
