import itertools

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tidewater.llm import exact_dedup, sharding
from tidewater.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import multiset


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cur = duck.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert multiset([tuple(r) for r in df.collect()], list(df.columns)) == multiset(cur.fetchall(), cols)


def test_exact_traps(trap_docs):
    out = exact_dedup.exact_dedup(trap_docs.withColumn("kept", trap_docs.doc_id), capacity=2).collect()
    assert len(out) == trap_docs.count()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in out}
    assert got[1] == (4, 2, False) and got[4] == (4, 2, True) and got[2] == (3, 2, False) and got[3] == (3, 2, True)
    assert got[5] == (6, 2, False) and got[9] == (9, 2, True) and got[None] == (None, 1, True)
    assert exact_dedup.exact_dedup(trap_docs.limit(0)).count() == 0


def test_directory_doubles_until_buckets_fit(spark):
    rows = [(i * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63) for i in range(1000)]
    entries = spark.createDataFrame([(h,) for h in rows + [5] * 40], "h bigint")
    cells = {r.cell: r for r in exact_dedup.directory(entries, 10, 16).collect()}
    held = {}
    for h in rows + [5] * 40:
        r = cells[(h % (1 << 64)) >> 54]
        assert r.bucket <= r.cell < r.bucket + (1 << (10 - r.local_depth))
        held[r.bucket, r.local_depth] = held.get((r.bucket, r.local_depth), 0) + 1
    assert all(n <= 16 or d == 10 for (_, d), n in held.items())


@pytest.mark.parametrize("d, bits", [(2, 3), (3, 2), (3, 3), (1, 4), (4, 2)])
def test_curve_visits_every_cell_by_unit_steps(d, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
    index = sharding.hilbert_index(cells, bits)
    order = np.argsort(index)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def slots_right(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(16))
    return by


def test_shards_over_the_whole_table(spark, duck):
    rows = QUERIES["op10_hilbert_shards"](spark, SMALL).collect()
    want = dict(duck.execute("SELECT doc_id, strlen(text) + 1 FROM documents").fetchall())
    assert {r.doc_id: r.size for r in rows} == want and len(rows) == len(want)
    counts = [len(s) for s in slots_right(rows).values()]
    assert max(counts) - min(counts) <= 1 and len(counts) == 16


def test_shards_prune(spark):
    docs = spark.read.parquet(f"{SMALL}/../sf0.01/documents.parquet")
    at = sharding.hilbert_shards(docs).join(docs.select("doc_id", "lang", "source"), "doc_id").collect()
    langs, sources = {}, {}
    for r in at:
        langs.setdefault(r.shard, set()).add(r.lang)
        sources.setdefault(r.shard, set()).add(r.source)
    assert sum(map(len, langs.values())) / 16 < 3.5 and sum(map(len, sources.values())) / 16 < 12


def test_shard_traps(trap_docs, tmp_path, spark):
    for law in ("rows", "bytes"):
        rows = sharding.hilbert_shards(trap_docs.withColumn("slot", trap_docs.doc_id), law=law).collect()
        assert len(rows) == trap_docs.count()
        slots_right(rows)
    assert {r["size"] for r in rows if r.doc_id in (2, 3)} == {1}
    assert sharding.hilbert_shards(trap_docs.limit(0)).count() == 0
    docs = trap_docs.filter("doc_id < 9").drop("slot")
    sharding.write_shards(docs, sharding.hilbert_shards(docs, n_shards=4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def test_sources_with_a_common_start_are_told_apart(spark):
    """Text dimensions are cut by whole values, however long their common beginning."""
    rows = [(i, f"text {i}", "en", f"https://example.org/crawl/{i % 16:02d}", 10) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    at = sharding.hilbert_shards(docs, dimensions=("source",)).join(docs.select("doc_id", "source"), "doc_id").collect()
    held = {}
    for r in at:
        held.setdefault(r.shard, set()).add(r.source)
    assert max(map(len, held.values())) <= 2 and sum(map(len, held.values())) <= 31


def test_text_cuts_come_from_all_rows(spark):
    """More rows than any sample would hold: the cuts are the values at the exact places."""
    rows = [(i, f"v{(i * i) % 9973:05d}" if i % 7 else None, "b" if i % 3 else "a") for i in range(20000)]
    meta = spark.createDataFrame(rows, "id bigint, x0 string, x1 string")
    got = sharding.text_cuts(meta, ["x0", "x1"], 32)
    for at, cuts in zip((1, 2), got):
        known = sorted(r[at] for r in rows if r[at] is not None)
        assert cuts == [known[i * len(known) // 32] for i in range(1, 32)]
    assert sharding.text_cuts(meta.limit(0), ["x0"], 32) == [[]]
    few = meta.filter("id in (1, 2)")  # fewer rows than cuts
    assert sharding.text_cuts(few, ["x1"], 4) == [["b", "b", "b"]]


def test_shard_digests_and_law(spark, duck):
    import zlib
    texts = dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    rows = QUERIES["op10_hilbert_shards"](spark, SMALL).collect()
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.law == "rows" and r.grown_shard is None for r in rows)


def test_rows_find_their_entries_through_the_directory(spark, docs_of, monkeypatch):
    docs = docs_of([(i, f"text {i % 40}") for i in range(200)])
    depth, cells, index = exact_dedup.build_index(docs, capacity=4)
    assert cells.count() > 1 and index.select("bucket").distinct().count() > 1
    assert {r.local_depth for r in cells.collect()} <= set(range(depth + 1)) and cells.agg({"n": "sum"}).first()[0] == 200
    assert exact_dedup.exact_dedup(docs, capacity=4).count() == 200
    real = exact_dedup.build_index

    def astray(*args):
        depth, cells, index = real(*args)
        return depth, cells.withColumn("bucket", cells.bucket + 1), index

    monkeypatch.setattr(exact_dedup, "build_index", astray)
    assert exact_dedup.exact_dedup(docs, capacity=4).count() == 0


def test_a_text_that_most_rows_share(spark, docs_of):
    docs = docs_of([(i, "hot" if i % 3 else f"text {i}") for i in range(6000)])
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs).collect()}
    assert len(got) == 6000 and got[1] == (5999, 4000) and got[3] == (3, 1)


def test_entry_lists_the_queries():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
