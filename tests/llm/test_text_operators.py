"""Operators over texts against plain versions of the same rules, and on odd rows."""

import array
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import bpe, catalog, chunks, classifier, lines, minhash, packing, quality_rules
from orderloom.llm.catalog import TOKENIZER
from orderloom.llm.shingles import shingle_sets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1
PROSE = [" ".join(f"w{d}x{i} of the" for i in range(40)) for d in range(6)]


# --- BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def odd_texts():
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "'s", "'", "'re", "'LL", "a", "Z", "9", "#", "é", "²", "Ⅷ", "字", "🙂", " ",
             " ", "\x1c", "\x85", "<|endoftext|>", "<|", "the", "́", "՘", "\x00", "१"]
    for _ in range(3000):
        yield "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
    yield from ("a" * 3000, "é" * 999, "the" * 400, " " * 700, "".join(rng.choice("abcdehinorst") for _ in range(3000)))


@pytest.mark.parametrize("kind", [bpe.Bpe, packing.FastBpe])
def test_ids_equal_the_tokenizer(tokenizer, kind):
    ours = kind(bpe.tokenizer_text(TOKENIZER))
    for text in odd_texts():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids, text
        assert ours.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)


def test_scanning_and_heap_merge_alike():
    ours, rng = bpe.Bpe(bpe.tokenizer_text(TOKENIZER)), random.Random(3)
    for _ in range(400):
        parts = [ours.byte_ids[b] for b in bytes(rng.choice(b"aehinorst e") for _ in range(rng.randint(0, 60)))]
        assert ours._merge_scanning([*parts]) == ours._merge_by_heap([*parts])


def test_encode_and_decode_frames(edge, edge_rows, nothing, tokenizer):
    both = bpe.decode(bpe.encode(edge, TOKENIZER), TOKENIZER)
    got = sorted((r.doc_id or LAST, r.ids, r.text) for r in both.collect())
    want = [(i or LAST, tokenizer.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in edge_rows]
    assert got == sorted(want)
    assert bpe.decode(bpe.encode(nothing, TOKENIZER), TOKENIZER).count() == 0


# --- packing ---------------------------------------------------------------------


def bins_of(lengths, capacity):
    """Best-fit decreasing, one item at a time: the remaining capacities."""
    left = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= length]
        if fits:
            left[min(fits)[1]] -= length
        else:
            left.append(capacity - length)
    return collections.Counter(left)


def test_plan_equals_item_by_item_packing():
    rng = random.Random(1)
    for _ in range(400):
        capacity = rng.choice((5, 13, 40))
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        bins = collections.defaultdict(list)
        for run in packing.best_fit_decreasing(collections.Counter(lengths), capacity):
            for j in range(run.pieces):
                bins[run.first_bin + j // run.per_bin].append((run.offset + j % run.per_bin * run.length, run.length))
        for items in bins.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
        assert collections.Counter(capacity - sum(n for _, n in b) for b in bins.values()) == bins_of(lengths, capacity)


def test_pack_places_every_id(edge, edge_rows, nothing, tokenizer):
    rows = packing.pack(edge, TOKENIZER, capacity=64).collect()
    want = collections.Counter()
    for i, text in edge_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for k, (start, size) in enumerate(packing.cut(len(ids), 64)):
            assert size == 64 or k == 0
            want[i, k, start, size, zlib.crc32(array.array("I", ids[start : start + size]).tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) == sum(bins_of([r.length for r in rows], 64).values())
    assert packing.pack(nothing, TOKENIZER).count() == 0


# --- quality rules ---------------------------------------------------------------


def plain_counts(text):
    words, places = WORDS.findall(text), collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    repeated = {i + k for own in places.values() if len(own) > 1 for i in own for k in range(5)}
    worded = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(worded) - len(set(worded)), len(repeated)


def test_quality_counts(edge, edge_rows, nothing):
    judged = quality_rules.judge(edge)
    assert set(judged.columns) == set(edge.columns)
    rows = judged.select("doc_id", "text", "quality.*").collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == plain_counts(r.text or "")
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (r.failed_rules == "") and not (r.kept and r.base_failed)
    kept = quality_rules.select_clean(edge)
    assert kept.schema == edge.schema and {r.doc_id for r in kept.collect()} >= {1, 3, None}
    assert quality_rules.judge(nothing).count() == 0


def test_repeated_windows_may_overlap(make_documents):
    texts = ["a a a a a a", "a b c d e f a b c d e", "a b c d a b c d a b c d", "a b c d e", ""]
    rows = quality_rules.judge(make_documents(list(enumerate(texts)))).select("text", "quality.n_repeat_words").collect()
    assert all(r.n_repeat_words == plain_counts(r.text)[4] for r in rows)


# --- lines -----------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, alphabet="abcé🙂"):
    text = list(text)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(text) + 1)
        text[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(alphabet)])
    return "".join(text)


def plain_lines(rows, edits, least):
    places = collections.defaultdict(list)
    for i, text in rows:
        for p, line in enumerate((text or "").split("\n")):
            if WORDS.search(line):
                places[line].append((i if i is not None else LAST, p))
    first = {line: min(own) for line, own in places.items()}
    long, links, near = [x for x in first if len(x) >= least], collections.Counter(), set()
    for n, a in enumerate(long):
        for b in long[:n]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                near.add(max(a, b, key=first.get))
                links.update((a, b))
    out = []
    for i, text in rows:
        parts, kept, exact, near_here = (text or "").split("\n"), [], 0, 0
        for p, line in enumerate(parts):
            if line in near:
                near_here += 1
            elif line in first and first[line] != (i if i is not None else LAST, p):
                exact += 1
            else:
                kept.append(line)
        changed = None if text is None else "\n".join(kept)
        out.append((str(i), changed, exact, near_here, sum(links[x] for x in parts)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance_and_segments(corpus, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(700):
        a = "".join(rng.choice("abcé🙂") for _ in range(rng.randint(6, 18)))
        b = edited(rng, a)
        pairs.append((a, b) if len(a) >= len(b) else (b, a))
    frame = corpus.createDataFrame(pairs, "a string, b string").filter(F.length("a") - F.length("b") <= edits)
    tagged = lines.with_tag(frame.withColumns({"x": F.length("a"), "y": F.length("b")}), "a").withColumnRenamed("tag", "t")
    checked = lines.with_tag(tagged, "b").select(
        "a", "b", lines.within_edits(F.col("a"), F.col("b"), edits).alias("near"),
        F.arrays_overlap(
            lines.probe_keys(F.col("a"), F.col("x"), edits), lines.entry_keys(F.col("b"), F.col("y"), edits)
        ).alias("met"),
        lines._count_gap(F.col("t"), F.col("tag")).alias("gap"),
    )
    for r in checked.filter(F.length("b") > edits).collect():
        assert r.near == (distance(r.a, r.b) <= edits), (r.a, r.b)
        if r.near:
            assert r.met and r.gap <= 2 * edits


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_few_keys_a_line_lose_no_near_line(corpus, edits):
    rng = random.Random(40 + edits)
    pairs = []
    for _ in range(900):  # lengths on both sides of several classes
        a = "".join(rng.choice("abcé🙂") for _ in range(rng.randint(24, 58)))
        b = a
        for _ in range(rng.randint(1, edits)):
            at, new = rng.randint(0, len(b)), rng.choice("abcé🙂")
            b = rng.choice((b[:at] + new + b[at:], b[:at] + b[at + 1:], b[:at] + new + b[at + 1:]))
        pairs.append((a, b))
    def keys(line):
        size = F.length(line)
        return lines.entry_keys(F.col(line), size, edits, 24), lines.shifted_keys(F.col(line), size, edits, 24, edits > 2)

    (a, a_shifted), (b, b_shifted) = keys("a"), keys("b")
    met = F.arrays_overlap(a, b) | F.arrays_overlap(a, b_shifted) | F.arrays_overlap(a_shifted, b)
    frame = corpus.createDataFrame(pairs, "a string, b string").filter("length(b) >= 24")
    checked = frame.select("a", "b", met.alias("met"), (F.size(a) + F.size(a_shifted)).alias("keys"))
    for r in checked.collect():
        assert r.met, (r.a, r.b)
        # in one class or two; there were 15 with two edits
        assert r.keys in {1: (2, 4), 2: (4, 8), 3: (8, 16)}[edits]


def test_line_marks_are_never_sent_to_every_task(corpus, make_documents):
    # else the work of the last join changes at some size of the corpus
    cleaned = lines.dedup_lines(make_documents([(1, "one line"), (2, "one line"), (3, "another")]))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted((r.doc_id, r.text) for r in cleaned.collect()) == [(1, "one line"), (2, ""), (3, "another")]


def test_line_dedup_equals_brute_force(corpus, make_documents):
    rng = random.Random(11)
    stock = ["".join(rng.choice("abcde fgh") for _ in range(rng.randint(10, 40))) for _ in range(12)] + ["", " ", "x"]
    rows = [
        (i if i % 9 else None if i == 0 else i, "\n".join(edited(rng, rng.choice(stock)) for _ in range(rng.randint(0, 6))))
        for i in range(60)
    ]
    rows += [(100, None), (101, "")]
    got = lines.dedup_lines(make_documents(rows), edits=2, near_chars=12).select("doc_id", "text", "lines.*").collect()
    ours = sorted(((str(r.doc_id), r.text, r.removed_exact, r.removed_near, r.n_links) for r in got), key=repr)
    assert ours == plain_lines(rows, 2, 12)


def test_lines_of_equal_letter_counts_are_told_apart(corpus, make_documents):
    # numbered lines two edits apart whose hashes agree in the last 19 bits
    numbered = corpus.range(100_000).select((F.col("id") / 100).cast("int").alias("page"), F.format_string("Page %06d of the manual", "id").alias("line"))
    low = numbered.withColumn("low", F.xxhash64("line").bitwiseAND(F.lit((1 << 19) - 1)))
    pair = low.groupBy("page", "low").agg(F.collect_list("line").alias("both")).filter(F.size("both") == 2).first()["both"]
    got = lines.dedup_lines(make_documents([*enumerate(pair)])).select("doc_id", "lines.*").collect()
    assert sorted((r.doc_id, r.removed_near, r.n_links) for r in got) == [(0, 0, 1), (1, 1, 1)]


def test_line_dedup_on_odd_rows(edge, edge_rows, nothing):
    cleaned = lines.dedup_lines(edge)
    assert set(cleaned.columns) == set(edge.columns)
    got = cleaned.select("doc_id", "text", "lines.*").collect()
    assert len(got) == len(edge_rows)
    texts = {(r.doc_id, r.text) for r in got}
    assert (4, None) in texts and (5, "") in texts and (6, " \t\n ") in texts
    assert sum("passage7 " in (r.text or "") for r in got) == 1
    assert lines.dedup_lines(nothing).count() == 0


# --- near duplicates -------------------------------------------------------------


def plain_groups(rows, similarity):
    """Per row the number of a row that stands for its class."""
    sets = [
        (i if i is not None else LAST,
         frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := WORDS.findall(t or "")) else frozenset())
        for i, t in rows
    ]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            one, two = sets[a][1], sets[b][1]
            if one == two or len(one & two) >= similarity * len(one | two):
                parent[root(a)] = root(b)
    return [root(x) for x in range(len(sets))]


def plain_classes(rows, similarity):
    roots, keys = plain_groups(rows, similarity), [i if i is not None else LAST for i, _ in rows]
    least = {r: min(k for k, other in zip(keys, roots) if other == r) for r in roots}
    return sorted((k, least[r]) for k, r in zip(keys, roots))


def test_signatures_estimate_weighted_similarity():
    rng, agree = np.random.default_rng(0), []
    for _ in range(60):
        elements = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        one, two = rng.integers(1, 9, 200).astype(float), rng.integers(1, 9, 200) * 0.7
        made = minhash.signatures(np.repeat([0, 1], 200), np.tile(elements, 2), np.concatenate([one, two]), 2, 130)
        agree.append((made[0] == made[1]).mean() - np.minimum(one, two).sum() / np.maximum(one, two).sum())
    assert abs(np.mean(agree)) < 0.02


def test_shingles_are_sets_of_five_words():
    texts = ["a b c d e f", "a b c d e f a b c d e f", "a b", "b a", "", "  a\tb\n", "é é é é é é é"]
    owner, elements, counts = shingle_sets([t.encode() for t in texts])
    by = [dict(zip(elements[owner == i].tolist(), counts[owner == i].tolist())) for i in range(len(texts))]
    assert [len(x) for x in by] == [2, 6, 1, 1, 0, 1, 1] and sum(by[1].values()) == 8
    assert by[2] == by[5] != by[3] and set(by[0]) < set(by[1]) and [*by[6].values()] == [3]


@pytest.mark.parametrize("weighted", [False, True])
def test_near_duplicates_equal_brute_force(make_documents, weighted):
    rng, rows = random.Random(5), []
    for group in range(6):
        base = [f"g{group}w{rng.randrange(10_000)}" for _ in range(120)]
        for copy in range(rng.choice((1, 3, 12))):
            words = [*base]
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10_000)}"
            rows.append((len(rows) * 7 % 101, " ".join(words)))
    got = minhash.classes(make_documents(rows), weighted=weighted).collect()
    assert sorted((r.key, r.class_id) for r in got) == plain_classes(rows, 0.8)


@pytest.mark.parametrize("weighted", [False, True])
def test_rare_shingles_find_every_link_between_classes(corpus, weighted):
    rng, shared, bags = random.Random(3), list(range(1, 121)), []
    for node in range(90):
        bag = collections.Counter(shared[: rng.choice((100, 110, 120))])
        for _ in range(rng.choice((0, 4, 9, 12, 13, 14, 20, 40))):
            # some changes are a copy's own, some are met in several copies
            bag.pop(rng.choice(shared), None)
            bag[rng.choice((1000 + node * 100 + rng.randrange(90), 500 + rng.randrange(30)))] += 1
        bags.append(bag)
    labels = [rng.choice((7, 7, 7, 100 + i)) for i in range(len(bags))]
    counted = [(i, sorted(b), [b[e] if weighted else 1 for e in sorted(b)]) for i, b in enumerate(bags)]
    sets = corpus.createDataFrame(counted, "node long, shingles array<long>, counts array<int>")
    nodes = corpus.createDataFrame([(i, lab) for i, lab in enumerate(labels)], "node long, label long")
    found = {(r.a, r.b) for r in minhash.rare_pairs(nodes, sets if weighted else sets.drop("counts"), 0.8, weighted).collect()}
    every = {(a, b) for b in range(len(bags)) for a in range(b) if labels[a] != labels[b]}

    def similarity(a, b):
        one, two = (dict(zip(*counted[n][1:])) for n in (a, b))
        least = sum(min(n, two.get(e, 0)) for e, n in one.items())
        return least / (sum(one.values()) + sum(two.values()) - least)

    links = {pair for pair in every if similarity(*pair) >= 0.8}
    assert links and links <= found <= every and len(found) < len(every) / 2


def test_one_document_of_each_class_stays(edge, edge_rows, nothing):
    got = minhash.classes(edge).collect()
    assert sorted((r.key, r.class_id) for r in got) == plain_classes(edge_rows, 0.8)
    kept = minhash.keep_first(edge)
    assert kept.schema.names == edge.schema.names
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 0 and ids.count(1) == 1 and {4, 5, 6} & set(ids) == {4}
    assert minhash.classes(nothing).count() == 0 and minhash.keep_first(nothing).count() == 0


def test_rows_that_share_an_id_or_have_none_are_not_lost(make_documents, corpus, monkeypatch):
    near = PROSE[1].replace("w1x5 ", "w1y5 ")
    rows = [(None, PROSE[0]), (None, PROSE[1]), (None, PROSE[2]), (7, PROSE[3]), (7, PROSE[4]), (7, PROSE[4]), (8, PROSE[5]),
            (None, PROSE[5]), (9, near), (7, PROSE[2]), (7, None), (None, "")]
    roots = plain_groups(rows, 0.8)
    by_text = {(i, t or ""): r for (i, t), r in zip(rows, roots)}
    kept = [(r.doc_id, r.text) for r in minhash.keep_first(make_documents(rows)).collect()]
    assert sorted(by_text[i, t or ""] for i, t in kept) == sorted(set(roots))
    keys = {r: min((i if i is not None else LAST) for (i, _), other in zip(rows, roots) if other == r) for r in roots}
    assert all((i if i is not None else LAST) == keys[by_text[i, t or ""]] for i, t in kept)
    monkeypatch.setattr(catalog, "read_table", lambda *_: make_documents(rows))
    found = catalog.QUERIES["op8_minhash_near_dedup"](corpus, "").collect()
    assert len(found) == len(rows) and sum(r.kept for r in found) == len(set(roots))
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(i for i, _ in rows)


# --- substrings ------------------------------------------------------------------


def plain_spans(text, least):
    """Borders by a rolling gear hash, one byte after the other."""
    data, h, hashes = text.encode(), 0, []
    padded = chunks.GAP + data
    for byte in padded:
        h = ((h << 1) + int(chunks._GEAR[byte])) & 0xFFFFFFFF
        hashes.append(h)
    space = [b in (0, 32) or 9 <= b <= 13 for b in padded]
    word = [space[32 + i - 1] and not space[32 + i] or 0xE3 <= b < 0xF8 for i, b in enumerate(data)]
    borders = [i for i in range(len(data)) if i == 0 or word[i] and not hashes[31 + i] & int(chunks.BORDER_BITS)] + [len(data)]
    for n, start in enumerate(borders[:-1]):
        end = next((e for e in borders[n + 1 :] if sum(word[start:e]) >= least), None)
        if end is not None:
            yield start, end


def plain_cut(rows, least):
    seen, out = {}, []
    for i, text in sorted(((i if i is not None else LAST, t) for i, t in rows), key=lambda r: r[0]):
        if text is None:
            out.append((i, None))
            continue
        data = text.encode()
        keep, own = np.ones(len(data), bool), set()
        for start, end in plain_spans(text, least):
            span = data[start:end]
            if span in own or seen.get(span, i) != i:
                keep[start:end] = False
            own.add(span)
            seen.setdefault(span, i)
        out.append((i, bytes(np.frombuffer(data, np.uint8)[keep]).decode()))
    return sorted(out, key=repr)


def test_substring_dedup_equals_brute_force(make_documents):
    rng = random.Random(2)
    passages = [" ".join(f"p{n}w{rng.randrange(99)}" for _ in range(55)) for n in range(3)] + ["字" * 70]
    rows = []
    for i in range(30):
        own = [" ".join(f"own{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30))) for _ in range(3)]
        rows.append((i * 11 % 31, "\n ".join(own[:1] + rng.sample(passages, rng.randint(0, 2)) + own[1:])))
    got = chunks.dedup_substrings(make_documents(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == plain_cut(rows, chunks.MIN_WORDS)
    assert any(r.repeats.first_ids for r in got)


def test_substring_dedup_on_odd_rows(edge, edge_rows, nothing):
    got = chunks.dedup_substrings(edge)
    assert set(got.columns) == set(edge.columns)
    rows = got.collect()
    # of two rows with one id and different texts each is cut by its own spans
    plain = [r for r in edge_rows if r[0] not in (None, 12)]
    ours = [(r.doc_id, r.text) for r in rows if r.doc_id not in (None, 12)]
    assert sorted(ours, key=repr) == plain_cut(plain, chunks.MIN_WORDS)
    texts = collections.Counter((r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest()) for r in rows)
    assert sum(n for (i, _), n in texts.items() if i is None) == 2
    assert chunks.dedup_substrings(nothing).count() == 0


def test_rows_without_an_id_are_documents_of_their_own(make_documents):
    passage = " ".join(f"shared{i}" for i in range(50))
    line = "a line that is long enough for the near join"
    for shared in (None, 7):
        cut = [r.text for r in chunks.dedup_substrings(make_documents([(shared, passage)] * 3)).collect()]
        assert sorted(cut) == ["", "", passage]
        rows = [(shared, line)] * 3 + [(shared, line + "!")]
        got = lines.dedup_lines(make_documents(rows)).select("text", "lines.*").collect()
        assert sum(r.text != "" for r in got) == 1 and sum(r.removed_exact + r.removed_near for r in got) == 3


# --- classifier ------------------------------------------------------------------


def test_density_equals_numpy(corpus):
    rng = np.random.default_rng(4)
    p = len(classifier.FEATURES)
    data = [(rng.normal(k, 1 + k, p).tolist(), k) for k in (0, 1) for _ in range(80)] + [([0.0] * p, None)]
    frame = corpus.createDataFrame(data, "x array<double>, label int")
    model = classifier.fit(frame)
    x = np.array([d for d, k in data])
    logs = []
    for k in (0, 1):
        inverse = model.factors[k].T @ model.factors[k]
        away = x - model.means[k]
        logs.append(model.priors[k] - model.logdets[k] / 2 - np.einsum("ij,jk,ik->i", away, inverse, away) / 2)
        assert np.allclose(model.means[k], x[[d[1] == k for d in data]].mean(0))
    got = [r.score for r in classifier.score(frame, model).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(logs[0] - logs[1])))


def test_classifier_learns_and_scores_all(edge, edge_rows, nothing, corpus):
    labels = corpus.createDataFrame([(1, 1), (2, 1), (9, 1), (12, 0), (8, 0), (5, None), (None, 0), (77, 1)], "doc_id long, quality int")
    out = F.col("doc_id") == 9
    rows = classifier.classify(edge, labels, F.coalesce(out, F.lit(False))).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id == 9) for r in rows)
    none = classifier.classify(edge, labels.limit(0), F.lit(False)).collect()
    assert {r.score for r in none} == {0.5}
    assert classifier.classify(nothing, labels, F.lit(False)).count() == 0
