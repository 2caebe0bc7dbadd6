"""Filter audit, conversation trie and vector join against plain versions, and on odd rows."""

import collections
import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference, oracle_connection
from orderloom.llm import audit, grid_join, topk, tries
from orderloom.llm.catalog import QUERIES, SQL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

# --- filter audit ----------------------------------------------------------------


def plain_audit(rows, labels):
    """Each order played through document by document."""
    failed = []
    for i, text, source in rows:
        words, text = WORDS.findall(text or ""), text or ""
        bad = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": any(j is not None and i is not None and j < i and (t or "") == text for j, t, _ in rows),
        }
        good, toxic = (any(r[0] == i is not None and r[k] == 1 for r in labels) for k in (1, 2))
        failed.append((source or "", {f for f, b in bad.items() if b}, good, toxic))
    out, shapley = {}, collections.Counter()
    for part in {f[0] for f in failed}:
        own = [f for f in failed if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order):
                before = set(order[:step])
                here = [f for f in own if not f[1] & before and name in f[1]]
                out[part, "".join(order), step + 1] = (
                    sum(not f[1] & (before | {name}) for f in own), len(here),
                    sum(bool(f[1] & before) and name in f[1] for f in own), sum(f[1] == {name} for f in own),
                    sum(f[2] for f in here), sum(f[3] for f in here),
                )
                shapley[part, name] += len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_every_order_played_through(corpus, edge_rows):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(("aa", "Bb", "#c", *map(str, range(400)))) for _ in range(rng.choice((3, 190, 230)))) for _ in range(12)]
    rows = [(rng.choice((*range(40), None)), rng.choice((*texts, None, "")), rng.choice(("x", "y", "", None))) for _ in range(70)]
    rows += [(i, t, "z") for i, t in edge_rows]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in (*range(0, 40, 2), 2, 4, None, 77)]
    docs = corpus.createDataFrame([(*r, 1, "m") for r in rows], "doc_id long, text string, source string, mask int, part string")
    marks = corpus.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit_filters(docs, marks).collect()
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    ours = {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in got}
    assert len(got) == len(ours) and ours == plain_audit(rows, labels)
    assert audit.audit_filters(docs.limit(0), marks).count() == 0
    assert {r.good_lost for r in audit.audit_filters(docs, marks.limit(0)).collect()} == {0}


def test_potentials_of_other_numbers_of_filters(corpus):
    rows = [("p", m, 0, 0) for m in (0, 1, 2, 4, 5, 7, 7, 15, 8, 12)]
    got = audit.audit(corpus.createDataFrame(rows, "part string, mask int, good long, toxic long"), "wxyz").collect()
    assert len(got) == 24 * 4
    totals = collections.Counter()
    for r in got:
        totals[r.filter_order[r.step - 1]] += r.removed
    assert all(r.shapley == totals[r.filter_order[r.step - 1]] for r in got) and sum(totals.values()) == 24 * 9


# --- conversation trie -----------------------------------------------------------


def plain_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(rebuilt[c]) == len(path))
        out.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids),
                    sum(q[:-1] == path for q in members if q), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string, node long, block string"


def made_turns(rng, long):
    rows = []
    for c in [*range(0, 30), *range(100, 130), 200, 205, 391, -3, -100, -101, 10**12]:
        for t in range(rng.randint(1, 8)):
            rows.append((c, rng.choice((t, t, t, None)) if t == 0 else t, rng.choice(("user", None, "")), rng.choice(("a", "bé🙂", None, ""))))
    rows += [(60, t, "user", "hot" if t % 3 else "x") for t in range(long)] + [(161, t, "user", "same") for t in range(long // 2)]
    rows += [(c, t, "user", "copy") for c in range(301, 390) for t in range(4)]
    rows += [(None, 0, "user", "lost"), (7, 9, None, ""), (7, 9, None, "")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_trie_equals_brute_force(corpus, monkeypatch, small):
    rng = random.Random(11)
    rows = made_turns(rng, 60)
    rng.shuffle(rows)
    if small:
        for name, value in (("LAST_ARCS", 40), ("IDS_PER_PIECE", 7), ("LEAST_BLOCK", 16)):
            monkeypatch.setattr(tries, name, value)
        monkeypatch.setattr(tries.list_ranks, "__defaults__", (40,))
    frame = corpus.createDataFrame([(*r, 5, "b") for r in rows], TURNS)
    got = sorted((tuple(r[c] for c in TRIE) for r in tries.conversation_trie(frame).collect()), key=repr)
    assert got == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(corpus):
    assert tries.conversation_trie(corpus.createDataFrame([], TURNS)).count() == 0
    assert tries.conversation_trie(corpus.createDataFrame([(None, 1, "a", "b", 1, "")], TURNS)).count() == 0
    bare = next(c for c in range(500, 600) if zlib.crc32(str(c).encode()) % 6 == 4 and c != 500)
    rows = [(bare, 0, "user", "gone"), (bare, 1, "user", "gone too")]
    got = tries.conversation_trie(corpus.createDataFrame([(*r, 1, "") for r in rows], TURNS)).collect()
    assert [tuple(r[c] for c in TRIE) for r in got] == plain_trie(rows) and len(got) == 1


def test_list_ranks(corpus):
    order = [*range(300)]
    random.Random(2).shuffle(order)
    links = [(x, order[i - 1] if i else None, order[i + 1] if i + 1 < len(order) else None) for i, x in enumerate(order)]
    got = {r["id"]: r["place"] for r in tries.list_ranks(corpus.createDataFrame(links, "id long, prev long, next long"), 20).collect()}
    assert got == {x: i for i, x in enumerate(order)}


# --- vector join -----------------------------------------------------------------


def plain_links(rows, cosine):
    def sound(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.abs(v).max() if sound(v) else None for _, v, _ in rows]
    unit = [u / np.sqrt(u @ u) if u is not None else None for u in unit]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if unit[a] is None or unit[b] is None or rows[a][2] is None or rows[a][2] != rows[b][2] or len(unit[a]) != len(unit[b]):
            continue
        if unit[a] @ unit[b] >= cosine:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    out = []
    for x, (i, _, _) in enumerate(rows):
        least = min((j for y, (j, _, _) in enumerate(rows) if root(y) == root(x) and j is not None), default=None)
        out.append((i, links[x], least, least is None or least == i))
    return sorted(out, key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, node long, part string"


def made_vectors(rng):
    rows = []
    for label in (0, 1, 2, None):
        for _ in range(60):
            rows.append((len(rows), rng.normal(0, 1, 16).tolist(), label))
        for _ in range(4):
            base = rng.normal(0, 1, 16)
            for spread in rng.uniform(0, 0.16, 12):
                rows.append((len(rows), (base + rng.normal(0, spread, 16)).tolist(), label))
    rows += [(1000 + i, [1.0] * 16, 1) for i in range(40)] + [(1000, [2.0] * 16, 1), (None, [1.0] * 16, 1), (None, [0.0, 1.0], 1)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [None] + [1.0] * 15, 1), (2004, [float("nan")] * 16, 1),
             (2005, [float("inf")] * 16, 1), (2006, [1e308] * 16, 1), (2007, [1e-320] * 16, 1), (2008, [1.0, 0.0], 1), (2009, [1.0, 0.1], 1),
             (2010, [-1.0] * 16, 1), (2011, [3.0], 2), (2012, [5.0], 2)]
    return rows


@pytest.mark.parametrize("rows_per_block, run", [(1024, 128), (9, 4)])
def test_vector_join_equals_brute_force(corpus, monkeypatch, rows_per_block, run):
    monkeypatch.setattr(grid_join, "RUN_ROWS", run)
    rows = made_vectors(np.random.default_rng(3))
    frame = corpus.createDataFrame([(*r, 1, "p") for r in rows], VECTORS)
    got = grid_join.near_vectors(frame, rows_per_block=rows_per_block).collect()
    ours = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr)
    assert ours == plain_links(rows, 0.93) and max(r.n_links for r in got) > 40
    assert grid_join.near_vectors(frame.limit(0)).count() == 0


def test_distant_blocks_are_skipped_and_close_ones_are_not(corpus):
    rng = np.random.default_rng(5)
    centres = rng.uniform(-3, 3, (64, 3))
    rows = [(int(i), "p", 3, (c - 0.05).tolist(), (c + 0.05).tolist()) for i, c in enumerate(centres)]
    boxes = corpus.createDataFrame(rows, "seq long, part string, dim int, low array<double>, high array<double>")
    got = {(r.one, r.two) for r in grid_join.close_blocks(boxes, 0.4, 64, 3).collect()}
    gaps = np.maximum(0, np.abs(centres[:, None] - centres[None]) - 0.1)
    want = {(i, j) for i in range(64) for j in range(i, 64) if (gaps[i, j] ** 2).sum() <= 0.16}
    assert got == want and len(want) < 64 * 20


def test_float_vectors(corpus):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [0.0, 1.0], 1)]
    frame = corpus.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(tuple(r) for r in grid_join.near_vectors(frame).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


# --- quality classifier ----------------------------------------------------------


def test_held_out_documents_are_told_apart(corpus):
    """Accuracy on labelled documents that the fit has not seen, on both sides of the threshold."""
    sf_dir = "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        pytest.skip("driver tables are not present")
    labels = corpus.read.parquet(f"{sf_dir}/labels.parquet").filter("quality is not null")
    scored = QUERIES["op6_quality_classifier"](corpus, sf_dir).join(labels, "doc_id").filter("held_out").collect()
    right = [r.predicted == r.quality for r in scored]
    assert len(right) > 50 and sum(right) >= 0.95 * len(right)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)


def test_walks_down_sorted_lists_equal_a_full_scan():
    rng = np.random.default_rng(2)
    for n, d, k in ((1, 3, 5), (40, 1, 3), (300, 8, 5), (300, 8, 400)):
        rows = np.floor(rng.normal(0, 3, (n, d)))
        order, ids = np.argsort(rows, axis=0, kind="stable"), rng.permutation(n)
        for query in (*np.floor(rng.normal(0, 3, (6, d))), np.zeros(d)):
            for own, depth in ((-1, 16), (n - 1, 1), (0, 1000)):
                best, _ = topk.threshold_search(rows, order, ids, query, own, k, depth)
                scores = rows @ query
                want = sorted((i for i in range(n) if i != own), key=lambda i: (-scores[i], ids[i]))[:k]
                assert best.tolist() == want


# --- queries ---------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_embedding_near_dedup", "op12_filter_audit", "op13_conversation_trie"])
def test_query_equals_sql(corpus, tiny_dir, name):
    assert difference(QUERIES[name](corpus, tiny_dir), oracle_connection(tiny_dir), SQL[name]) is None
