"""Search, archives, shards and the pipeline against plain versions, and on odd rows."""

import base64
import collections
import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import difference, oracle_connection
from orderloom.llm import sharding, topk, warc
from orderloom.llm.catalog import QUERIES, SQL
from orderloom.llm.common import materialize, scratch_path
from orderloom.llm.graph import components

# --- top-k search ----------------------------------------------------------------


def plain_top(rows, k):
    sound = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(sound):
        if i is not None and i % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(q, c)), j if j is not None else 1 << 63) for m, (j, c) in enumerate(sound) if m != n and len(c) == len(q)]
            out += [(i, rank, j if j < 1 << 63 else None, -s) for rank, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_top_k_equals_brute_force(corpus, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", 70)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 2)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.2, 8).round(2).tolist()) for i in range(260)]
    rows += [(300, [0.0] * 8), (301, [0.5] * 8), (302, [0.5] * 8), (302, [0.5] * 8), (350, [0.5] * 8), (350, [0.5] * 8)]
    rows += [(400, None), (450, [None] + [1.0] * 7), (500, [float("nan")] * 8), (550, [float("inf")] * 8), (None, [0.5] * 8),
             (600, [1.0, 2.0]), (601, [2.0, 1.0]), (650, [1e12] * 8), (651, [-1e12] * 8)]
    frame = corpus.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, uid int")
    asks = F.col("vec_id") % 50 == 0
    got = topk.top_k(frame, asks, 5).collect()
    cut = [(a, b, c, max(-(1 << 63), min((1 << 63) - 1, s))) for a, b, c, s in plain_top(rows, 5)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(cut, key=repr)
    assert topk.top_k(frame.limit(0), asks, 5).count() == 0


def test_top_k_sends_no_copies_of_queries_to_the_driver(corpus, monkeypatch):
    for name, value in (("CANDIDATES_PER_BLOCK", 16), ("QUERIES_PER_BLOCK", 3), ("SHELVES", 4)):
        monkeypatch.setattr(topk, name, value, raising=False)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.3, 6).round(1).tolist()) for i in range(0, 3000, 10)]
    frame = corpus.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("vec_id") % 50 == 0, 4)
    got = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan and "FlatMapCoGroups" in plan
    assert sorted((tuple(r) for r in got), key=repr) == plain_top(rows, 4)


# --- archives --------------------------------------------------------------------


def test_archive_round_trip(corpus):
    pages = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, None), (4, "u", ""), (5, "é", "ü🙂" * 9000),
             (6, "http://a/", "same"), (None, "n", "same"), (7, "w", "WARC/1.1\r\n\r\n\x1f\x8b"), (7, "w", "other")]
    frame = corpus.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, key string, payload string")
    folder = scratch_path(corpus, "warc-test")
    files = warc.write_archive(frame, folder, file_bytes=300)
    assert files.agg(F.sum("records")).first()[0] == len(pages) and files.count() > 1
    back = warc.read_archive(corpus, folder, files).collect()
    assert all(r.problem is None for r in back) and len(back) == len(pages)
    data = {(i, (h or "").encode()) for i, _, h in pages}
    for r in back:
        if r.record_type == "response":
            assert (r.page_id, bytes(r.payload)) in data and r.payload_bytes == len(r.payload)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
    assert {(r.page_id, r.refers_to, r.payload_bytes) for r in back if r.record_type == "revisit"} == {(2, 1, 4), (6, 1, 4), (None, 1, 4), (4, 3, 0)}
    empty = warc.write_archive(frame.limit(0), folder + "-none")
    assert empty.count() == 0
    some = warc.write_archive(frame, folder + "-large", least_revisit_bytes=5)
    assert warc.read_archive(corpus, folder + "-large", some).filter("record_type = 'revisit'").count() == 0


def records(packed):
    made = [warc.record(i, f"http://x/{i}", f"page {i} ".encode() * 20, None) for i in range(6)]
    return [gzip.compress(r, mtime=0) for r in made] if packed else made


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_recovers_what_follows_damage(packed):
    parts, rng = records(packed), random.Random(6)
    whole = b"".join(parts)
    assert [f.fields["page-id"] for f in warc.salvage(whole)] == [*"012345"]
    for _ in range(150):
        hit = rng.randrange(6)
        at = rng.randrange(len(parts[hit]))
        kind = rng.choice(("flip", "cut", "junk"))
        bad = bytearray(parts[hit])
        if kind == "flip":
            bad[at] ^= 0x41
        elif kind == "cut":
            del bad[at:]
        else:
            bad[at:at] = b"\x1f\x8b\x08WARC/1.1\r\njunk"
        data = b"".join([*parts[:hit], bytes(bad), *parts[hit + 1 :]])
        found = [*warc.salvage(data)]
        ids = [f.fields["page-id"] for f in found if not f.problem and "page-id" in f.fields]
        # records further on than the one after the damage are always recovered
        assert set("012345") - {str(hit), str(hit + 1)} <= set(ids) or not packed
        at = 0
        for f in found:
            assert f.offset >= at
            at = f.offset + f.length
        assert at == len(data) and sum(f.length for f in found) == len(data)


# --- shards ----------------------------------------------------------------------


def test_shards_are_even_and_copies_stay_together(corpus, make_documents):
    rng, rows = random.Random(9), []
    for i in range(900):
        rows.append((i, f"text {rng.randrange(10**9)} " * rng.randint(1, 20)))
    rows += [(1000 + i, f"copy {i % 40}" * 30) for i in range(160)] + [(2000 + i, "hot " * 40) for i in range(600)]
    rows += [(3000, None), (3001, ""), (None, "no id"), (3002, "long " * 3000), (3000, None)]
    got = sharding.shard(make_documents(rows), n_shards=8).collect()
    assert len(got) == len(rows)
    sizes, slots, spread = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    by_id = {i: t or "" for i, t in rows}
    for r in got:
        text = by_id[r.doc_id].encode()
        assert r["size"] == len(text) + 16 and r.text_crc32 == zlib.crc32(text)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        spread[by_id[r.doc_id]].add(r["shard"])
    mean = sum(sizes.values()) / 8
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean
    assert all(sorted(own) == [*range(len(own))] for own in slots.values())
    assert sum(len(s) > 1 for t, s in spread.items() if t.startswith("copy")) <= 4 and len(spread["hot " * 40]) < 8
    assert sharding.shard(make_documents([])).count() == 0


@pytest.mark.parametrize("linked", [0.8, 1.0])
def test_pairs_share_a_shard_however_many_there_are(make_documents, linked):
    pairs = round(400 * linked)
    rows = [(i, f"pair {i % pairs:04d} " * 20) for i in range(2 * pairs)]
    rows += [(1000 + i, f"sole {i:04d} " * 20) for i in range(800 - 2 * pairs)]
    texts, spread, sizes = dict(rows), collections.defaultdict(set), collections.Counter()
    for r in sharding.shard(make_documents(rows), n_shards=8).collect():
        spread[texts[r.doc_id]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean
    assert sum(len(s) > 1 for s in spread.values()) == 0


def test_large_groups_gather_where_all_are_copies(make_documents):
    rows = [(i, f"hot {i % 2} " * 40) for i in range(1200)] + [(2000 + i, f"pair {i % 200:03d} " * 20) for i in range(400)]
    texts, spread, sizes = dict(rows), collections.defaultdict(set), collections.Counter()
    for r in sharding.shard(make_documents(rows), n_shards=8).collect():
        spread[texts[r.doc_id]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean
    hot = [t for t in spread if t.startswith("hot")]
    assert all(len(spread[t]) <= 600 * (len(t) + 16) / mean + 2 for t in hot)
    assert sum(len(s) > 1 for t, s in spread.items() if t not in hot) <= 8


def test_levels_fill_the_lightest():
    assert sharding._level([10, 0, 4], 6) == [0, 5, 1]
    assert sum(sharding._level([0, 0, 0, 0], 400)) == 400


def test_components(corpus):
    rng = random.Random(12)
    edges = [(a, a + 1) for a in range(40)] + [(rng.randrange(50, 200), rng.randrange(50, 200)) for _ in range(90)] + [(300, 300)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        one, two = sorted((root(a), root(b)))
        parent[two] = one
    got = {r["node"]: r["component"] for r in components(corpus.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components(corpus.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- queries and pipeline --------------------------------------------------------


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)] and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op3_quality_rules", "op5_topk_search", "op9_warc"])
def test_query_equals_sql(corpus, tiny_dir, name):
    assert difference(QUERIES[name](corpus, tiny_dir), oracle_connection(tiny_dir), SQL[name]) is None


def test_pipeline_on_odd_rows(corpus, edge):
    docs, columns = edge, edge.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialize(stage(corpus, docs, ""), name)
        assert docs.columns == columns and docs.dtypes == before.dtypes
    kept = docs.select("doc_id", "text").collect()
    assert kept and {r.doc_id for r in kept}.isdisjoint({4, 5, 6, 8})  # texts of few words went
    packed = corpus_pipeline.STAGES[-1][1](corpus, docs, "")
    assert packed.select("doc_id").distinct().count() == len({r.doc_id for r in kept})
    own = {"lines": "q", "repeats": "r", "quality": "q"}
    sample = edge.drop("lines", "quality").withColumns({"lines": F.lit("q"), "quality": F.lit("q")}).select(*columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert all(r[c] == v for r in stage(corpus, sample, "").collect() for c, v in own.items())


def test_pipeline_on_an_empty_table(corpus, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(corpus, docs, ""), name)
        assert docs.count() == 0
