import hashlib

import corpus_pipeline as cp
from tests.conftest import SMALL
from tests.llm.test_near import brute as near
from tests.llm.test_suffix import brute as repeats
from tests.llm.test_tokens import packed_right


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(cp.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "suffix_dedup", "best_fit_packing"]

    def step(name, docs):
        out = stages[name](spark, docs, SMALL)
        if name != "best_fit_packing":
            assert out.columns == list(cp.COLUMNS)
        return cp.written(out, "test"), {r.doc_id: r.text for r in out.collect()} if name != "best_fit_packing" else None

    all_ = {r.doc_id: r.text for r in docs.collect()}
    named, texts = step("language_id", docs)
    assert set(texts) <= set(all_) and len(texts) >= 0.95 * len(all_)
    unique, kept = step("exact_dedup", named)
    assert kept == {max(i for i, t in texts.items() if t == text): text for text in set(texts.values())}
    apart, alone = step("near_dedup", unique)
    assert set(alone) == {root for _, root in near(list(kept.items())).values()}
    cut, left = step("suffix_dedup", apart)
    want = repeats(list(alone.items()))
    assert set(left) == set(alone)
    for i, t in left.items():
        if want[i][3] != hashlib.sha256(t.encode()).hexdigest():  # a character was cut in two
            assert 0 <= want[i][0] - want[i][1] - len(t.encode()) <= 6
    packed_right(stages["best_fit_packing"](spark, cut, SMALL).collect(), left)


def texts(df):
    return sorted((r.doc_id or 0, r.text or "") for r in df.collect())


def test_traps(spark, trap_docs):
    """Every stage on nulls, empty and long texts, ties, repeated rows and clashing names: exact rows."""
    stages, wide = dict(cp.STAGES), trap_docs
    for c in ("kept", "_row2", "ord", "id"):
        wide = wide.withColumn(c, trap_docs.doc_id)
    rows = [(r.doc_id or 0, r.text or "") for r in trap_docs.collect()]
    for name, stage in cp.STAGES:
        assert stage(spark, trap_docs.limit(0), SMALL).count() == 0
    named = texts(stages["language_id"](spark, wide, SMALL))
    letterless = [(2, ""), (3, ""), (7, " \t\n")]
    assert named == sorted(r for r in rows if r not in letterless)
    once = {}
    for i, t in rows:
        once[t] = max(i, once.get(t, 0))
    assert texts(stages["exact_dedup"](spark, wide, SMALL)) == sorted((i, t) for t, i in once.items())
    near_ = texts(stages["near_dedup"](spark, wide, SMALL))
    assert near_ == sorted([(1, "a b c"), (2, ""), (3, ""), rows[4], (0, "null id"), (7, " \t\n"), rows[8], rows[9], rows[11]])
    cut = {i: t for i, t in texts(stages["suffix_dedup"](spark, wide, SMALL))}
    assert cut[6] == "" and cut[5] == "lorem ipsum dolor sit amet " and cut[8] == rows[8][1] and len(cut) == 11
    assert stages["suffix_dedup"](spark, wide, SMALL).count() == len(rows)
    packed = stages["best_fit_packing"](spark, wide, SMALL).collect()
    assert sum(r.start == 0 for r in packed) == len(rows)


def test_exact_copies_are_decided_row_by_row(spark, docs_of):
    docs = docs_of([(1, "a b c"), (1, "d e f"), (2, "a b c"), (None, "x"), (None, "x"), (3, "y"), (3, "y"), (None, "y")])
    assert texts(cp.drop_copies(spark, docs, SMALL)) == [(0, "x"), (1, "d e f"), (2, "a b c"), (3, "y")]


def test_repeats_are_cut_once_from_every_row_of_an_id(spark, docs_of):
    import random
    rng = random.Random(1)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, own = prose(150), [prose(120) + str(i) for i in range(5)]
    rows = [(1, own[0] + line), (2, own[1] + line), (2, own[2] + line), (2, own[3] + line), (None, own[4] + line), (None, None)]
    assert texts(cp.cut_repeats(spark, docs_of(rows), SMALL)) == sorted(
        [(1, own[0] + line), (2, own[1]), (2, own[2]), (2, own[3]), (0, own[4]), (0, "")])


def test_a_cut_takes_parts_of_characters_only(spark, docs_of):
    """Genuine replacement characters stay; a character whose bytes are parted goes."""
    line = "".join(chr(0x100 + i) for i in range(80))
    first, second = chr(0x1A0), chr(0x1E0)  # they differ in their first byte only
    rows = [(1, "\ufffd1 " + first + line + " a"), (2, "\ufffd2 " + second + line + "\ufffd end"), (3, "\ufffd untouched")]
    got = dict(texts(cp.cut_repeats(spark, docs_of(rows), SMALL)))
    assert got == {1: rows[0][1], 2: "\ufffd2 \ufffd end", 3: rows[2][1]}
    kept = cp.cut_repeats(spark, docs_of(rows), SMALL).collect()
    assert all(r.n_chars == len(r.text) for r in kept)


def test_language_is_decided_row_by_row(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = spark.createDataFrame([(5, "12 34", "en", "s", 5), (5, None, "en", "s", 0), (None, "!!", None, "s", 2)], docs.schema)
    kept = cp.keep_languages(spark, docs.unionByName(more), SMALL)
    assert kept.columns == list(cp.COLUMNS)
    assert sorted(map(str, kept.collect())) == sorted(map(str, cp.keep_languages(spark, docs, SMALL).collect()))


def test_near_copies_without_an_id_stay(spark, docs_of):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "clean words of its own")]
    left = cp.drop_near_copies(spark, docs_of(rows), SMALL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted((i or 0, t) for i, t in rows if i != 2)
