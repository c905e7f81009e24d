"""The dealt operators against brute force, and their odd inputs, on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.llm import (
    best_fit, common, decontaminate, license_scan, line_dedup, order_minhash, pii, quality, queries, sharding, spotsigs,
    suffix_dedup,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# columns whose names the operators use inside
CLASH = DOCS + ", node string, h string, row string, score double, held string, t string, `__llm_h` string"


@pytest.fixture(scope="module")
def documents(spark):
    return common.read_table(spark, SF, "documents").cache()


def odd(spark, schema=CLASH):
    """NULLs in every column, empty, repeated and very long texts, ties, clashing columns."""
    long_text = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "", "en", "s", 0), (3, None, None, None, None),
            (None, "a b c d e f", "en", None, 11), (None, None, None, None, None), (4, long_text, "en", "s", len(long_text)),
            (5, long_text + " tail", "en", "s", 1), (6, "ä" * 500, "de", "t", 500), (7, " \n \n", "en", "t", 4)]
    pad = (None,) * (len(T._parse_datatype_string(schema).fields) - 5)
    return spark.createDataFrame([r + pad for r in rows], schema)


def labels_for(spark, n=400):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(n)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


# every operator on odd rows and on an empty table -------------------------------------------------

def _operators(spark):
    bench = spark.createDataFrame([(1, "a b c d e f a b c d e f"), (2, None), (None, "x" * 40), (3, "")], "item_id long, text string")
    trees = quality.fit_quality(odd(spark), labels_for(spark))
    return {
        "licenses": lambda d: license_scan.scan_licenses(d), "spotsigs": lambda d: spotsigs.fingerprints(d),
        "spot_pairs": lambda d: spotsigs.near_pairs(d), "near": lambda d: order_minhash.near_duplicates(d),
        "keep_one": lambda d: order_minhash.keep_one(d), "pack": lambda d: best_fit.pack_documents(d, queries.tokenizer_file()),
        "suffix": lambda d: suffix_dedup.remove_repeats(d), "matches": lambda d: decontaminate.find_matches(d, bench),
        "clean": lambda d: decontaminate.drop_contaminated(d, bench), "shards": lambda d: sharding.assign_shards(d, 4000),
        "score": lambda d: quality.score_quality(d, trees), "good": lambda d: quality.keep_quality(d, trees),
        "lines": lambda d: line_dedup.drop_boilerplate(d), "pii": lambda d: pii.digest(pii.detect(d)),
    }


PER_ROW = {"spotsigs", "near", "suffix", "shards", "score", "lines", "pii"}


@pytest.mark.parametrize("name", ["licenses", "spotsigs", "spot_pairs", "near", "keep_one", "pack", "suffix", "matches", "clean",
                                  "shards", "score", "good", "lines", "pii"])
def test_odd_rows_and_empty_table(spark, name):
    op, d = _operators(spark)[name], odd(spark)
    out = op(d).collect()
    if name in PER_ROW:
        assert len(out) == d.count()
    if name in ("keep_one", "clean", "good", "lines"):
        assert op(d).columns == d.columns
    assert op(d.limit(0)).collect() == []


# 1 ------------------------------------------------------------------------------------------------

def test_patience_on_known_alignment():
    a, b = "x a b c y d e".split(), "a b q c d z e".split()
    assert [(a[i], b[j]) for i, j in license_scan.patience(a, b)] == [(w, w) for w in "abcde"]
    assert license_scan.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 4)]) == [(1, 1), (2, 2), (4, 4)]


def test_license_found_with_changes_and_clean_text_left(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    t = license_scan.TEMPLATES["mit-grant"].replace("associated ", "").replace("hereby", "hereby, freely,")
    d = spark.createDataFrame([(1, f"{filler} {t} {filler}"), (2, filler), (3, "Released under the MIT License.")], "doc_id long, text string")
    out = {(r.doc_id, r.license): r for r in license_scan.scan_licenses(d).collect()}
    assert set(out) == {(1, "mit-grant"), (3, "mit-notice")}
    assert out[1, "mit-grant"].start_word == 300 and 0.8 <= out[1, "mit-grant"].coverage < 1


def test_license_coverage_does_not_depend_on_its_place():
    template = license_scan.words(license_scan.TEMPLATES["mit-grant"])
    n, cut = len(template), template.index("copy") + 1
    changed = ["x1" if w == "free" else "x2" if w == "files" else w for w in template]
    fill = lambda k: [f"f{i}" for i in range(k)]
    for gap in (14, 26, 3 * n):  # the last in pieces, over stretches longer than two templates
        for words, share in ((template, 1.0), (changed, (n - 2) / n)):
            inner = [f"g{i}" for i in range(gap)]
            third = cut // 2
            stretched = words[:cut] + inner + words[cut:] if gap < n else (
                words[:third] + inner[:n - 1] + words[third:cut] + inner[n - 1:2 * n - 2] + words[cut:])
            for at in range(2 * n):
                got = max(license_scan.covers(fill(at) + stretched + fill(60), template, 0.8), default=None)
                assert got == (share, at, at + len(stretched)), (gap, at, got)


def test_increasing_and_patience_against_plain_searches():
    """The chain is as long as the longest by dynamic programming; an alignment is a common subsequence,
    no longer than the longest one, and holds it whole where all words are unique."""
    rng = random.Random(12)
    for _ in range(200):
        pairs = [(x, rng.randrange(12)) for x in range(rng.randrange(12))]
        longest = [0] * len(pairs)
        for i, (_, y) in enumerate(pairs):
            longest[i] = 1 + max([longest[j] for j in range(i) if pairs[j][1] < y], default=0)
        chain = license_scan.increasing(pairs)
        assert len(chain) == max(longest, default=0) and all(p in pairs for p in chain)
        assert all(a < c and b < d for (a, b), (c, d) in zip(chain, chain[1:]))
    for k in range(200):
        words = "abcdefghijklmnopqrstuvwxyz"[:26 if k % 2 else 6]
        a, b = ([rng.choice(words) for _ in range(rng.randrange(25))] for _ in range(2))
        if k % 2:  # unique words: the longest common subsequence is the longest increasing chain of places
            a, b = (rng.sample(words, rng.randrange(1, 20)) for _ in range(2))
        lcs = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                lcs[i + 1][j + 1] = lcs[i][j] + 1 if a[i] == b[j] else max(lcs[i][j + 1], lcs[i + 1][j])
        found = license_scan.patience(a, b)
        assert all(a[i] == b[j] for i, j in found) and all(i < x and j < y for (i, j), (x, y) in zip(found, found[1:]))
        assert len(found) <= lcs[-1][-1] and (not k % 2 or len(found) == lcs[-1][-1])


def test_every_passage_of_a_long_license_is_found(spark):
    """A license of hundreds of words, changed here and there, three times in a text and once in part."""
    rng = random.Random(13)
    text = [rng.choice("abcdefgh") + rng.choice("ijklmno") + str(rng.randrange(60)) for _ in range(400)]
    fill = lambda n: [f"own{rng.randrange(10**6)}" for _ in range(n)]
    changed = lambda: [w if rng.random() > 0.05 else "other" for w in text]
    copies = [text, changed(), changed()]
    doc, places = fill(700), []
    for c in copies:
        places.append((len(doc), len(doc) + 400))
        doc += c + fill(rng.randrange(3, 900))
    doc += text[:300]  # three quarters are too few
    d = spark.createDataFrame([(1, " ".join(doc)), (2, " ".join(fill(50) + text[:200] + fill(30) + text[200:]))], "doc_id long, text string")
    out = sorted(map(tuple, license_scan.scan_licenses(d, {"long": " ".join(text), "mit": license_scan.TEMPLATES["mit-notice"]}).collect()))
    assert [r[:2] for r in out] == [(1, "long")] * 3 + [(2, "long")]
    for (_, _, share, start, end), (a, b) in zip(sorted(out[:3], key=lambda r: r[3]), places):
        assert share >= 0.9 and abs(start - a) <= 8 and abs(end - b) <= 8
    assert out[3][2:] == (1.0, 50, 480)


def test_two_grants_in_one_text_are_two_passages(spark):
    grant = license_scan.TEMPLATES["mit-grant"]
    d = spark.createDataFrame([(1, f"{grant} and {grant}"), (2, f"{grant} {license_scan.TEMPLATES['bsd-grant']} {grant}")], "doc_id long, text string")
    out = sorted(map(tuple, license_scan.scan_licenses(d).collect()))
    n = len(license_scan.words(grant))
    assert out[:2] == [(1, "mit-grant", 1.0, 0, n), (1, "mit-grant", 1.0, n + 1, 2 * n + 1)]
    assert [r[1] for r in out[2:]] == ["bsd-grant", "mit-grant", "mit-grant"]


# 2 ------------------------------------------------------------------------------------------------

def test_spotsigs_next_document_and_edit(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    order = sorted(rows, reverse=True)
    follows = {x[0]: order[(k + 1) % len(order)][1] for k, x in enumerate(order)}
    got = {r.doc_id: r for r in spotsigs.fingerprints(documents).collect()}
    for i, t in rows:
        n = follows[i]
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        own, changed = spotsigs.signatures(t), spotsigs.signatures(e)
        assert got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].fingerprint == spotsigs.fingerprint(own)
        assert got[i].near_edited == spotsigs.likeness(own, changed)
        assert got[i].near_next == spotsigs.likeness(own, spotsigs.signatures(n))


def test_spot_pairs_equal_brute_force(spark, documents):
    sets = {tuple(spotsigs.signatures(r.text)) for r in documents.collect()} - {()}
    want = {frozenset((spotsigs.fingerprint(list(a)), spotsigs.fingerprint(list(b)))) for a in sets for b in sets
            if a < b and spotsigs.likeness(list(a), list(b), 0.8) >= 0.8}
    got = {frozenset((r.a, r.b)) for r in spotsigs.near_pairs(documents).collect()}
    assert got == want and want


# 3 ------------------------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_equals_full_table():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.choice("abcd") for _ in range(rng.randrange(25))]
        b = [c for c in a if rng.random() > 0.15] + [rng.choice("abcd") for _ in range(rng.randrange(3))]
        for limit in (0, 2, 5, 30):
            d = distance(a, b)
            assert order_minhash.aligned_distance(a, b, limit) == (d if d <= limit else limit + 1)


def shingles(t):
    w = order_minhash.words(t)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_classes_hold_all_similar_pairs_and_no_others(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(documents).collect()}
    members = {}
    for i, t in rows:
        members.setdefault(got[i], []).append((i, t))
        assert got[i] <= i
    sets = {i: shingles(t) for i, t in rows}
    for i, t in rows:
        for j, u in rows:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                assert got[i] == got[j]
    for group in members.values():  # every member is linked to another one
        for i, t in group:
            assert len(group) == 1 or any(
                t == u or order_minhash.similarity(order_minhash.words(t), order_minhash.words(u)) is not None
                for j, u in group if j != i)


def test_group_of_copies_around_a_shared_passage(spark):
    """Documents that share one long passage but are unlike, with near copies among them."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(60)]
    rows = []
    for k in range(60):
        own = [word() for _ in range(40)]
        rows.append((2 * k, " ".join(own + passage)))
        near = list(own)
        near[20] = word()
        rows.append((2 * k + 1, " ".join(near + passage)))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(d).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    assert sorted(r.doc_id for r in order_minhash.keep_one(d).collect()) == [2 * k for k in range(60)]


def test_near_copies_in_a_group_of_many_unlike_texts(spark):
    """Edits are scattered: a pair shares sketches of the passage only, with many others."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(100)]
    rows, want = [], {}
    for k in range(400):
        own = [word() for _ in range(40)]
        near = [word() if i % 2 else w for i, w in enumerate(own)]
        rows += [(2 * k, " ".join(own + passage)), (2 * k + 1, " ".join(near + passage))]
        one, two = (order_minhash.sketch(np.array([xxhash.xxh64_intdigest(w) for w in t + passage], np.uint64)) for t in (own, near))
        want |= {2 * k: 2 * k, 2 * k + 1: 2 * k if (one == two).any() else 2 * k + 1}
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert order_minhash.similarity(*(order_minhash.words(t) for _, t in rows[:2])) >= 0.8
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(d).collect()}
    assert got == want


def test_link_to_a_member_that_is_linked_to_the_smallest(spark):
    """b-d aligns, and so does b with longer texts that are the smallest wherever b and d meet; d doesn't align with those."""
    rng, rows, want = random.Random(9), [], {}
    draw = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    key = lambda t: hashlib.md5(t.encode()).digest()
    for k in range(0, 100, 20):
        w = draw(850)
        b, d = " ".join(w), " ".join(w[:700])
        longer = [t for t in (" ".join(w + draw(150)) for _ in range(200)) if key(t) < min(key(b), key(d))][:12]
        rows += [(k + i, t) for i, t in enumerate([*longer, b, d])]
        want |= {k + i: k for i in range(len(longer) + 2)}
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


@pytest.mark.parametrize("block", [4, 256])
def test_classes_equal_brute_force_over_shared_sketches(spark, monkeypatch, block):
    """Texts of many sizes round common passages, families of copies beside them: any two that share a sketch and
    align are in one class, and classes hold nothing else, however small the blocks are."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    monkeypatch.setattr(order_minhash, "BLOCK_BYTES", block * 400)
    rng = random.Random(11)
    draw = lambda n: [rng.choice(pool) for _ in range(n)]
    pool = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    passages = [draw(30), draw(60)]
    texts = []
    for k in range(70):
        own = draw(rng.choice([3, 8, 20, 60])) + passages[k % 2] + draw(rng.choice([0, 5, 9]))
        texts.append(own)
        for _ in range(rng.choice([0, 0, 1, 5])):
            near = list(own)
            for i in rng.sample(range(len(near)), rng.randrange(len(near) // 4)):
                near[i] = rng.choice(pool)
            texts.append(near)
    family = draw(80)
    for _ in range(40):
        near = list(family)
        near[rng.randrange(80)] = rng.choice(pool)
        texts.append(near)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sketches = [order_minhash.sketch(np.array([xxhash.xxh64_intdigest(w) for w in t], np.uint64)) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if (sketches[i] == sketches[j]).any() and order_minhash.similarity(texts[i], texts[j]) is not None:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def test_rows_of_a_large_group_grow_with_its_size(spark, monkeypatch):
    """Unlike texts round one passage, near copies among them: twice as many take about twice the rows, not four times."""
    monkeypatch.setattr(order_minhash, "BLOCK", 8)
    monkeypatch.setattr(order_minhash, "EARLIER", 2, raising=False)
    made, by_blocks = [], order_minhash._by_blocks

    def counted(dealt, *more):
        made.append(dealt.count())
        return by_blocks(dealt, *more)

    monkeypatch.setattr(order_minhash, "_by_blocks", counted)
    rng, rows, sums = random.Random(13), [], []
    draw = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    passage = draw(70)
    for k in range(0, 320, 2):
        own = draw(30)
        rows += [(k, " ".join(own + passage)), (k + 1, " ".join(own[:14] + draw(2) + own[16:] + passage))]
    for n in (160, 320):
        made.clear()
        got = order_minhash.near_duplicates(spark.createDataFrame(rows[:n], "doc_id long, text string").repartition(4)).collect()
        assert {r.doc_id: r.class_id for r in got} == {i: i - i % 2 for i in range(n)}
        sums.append(sum(made))
    assert sums[1] <= 2.6 * sums[0]


def test_words_of_one_component_deal_no_rows(spark):
    """A word whose rows are all of one component has nobody to meet; others keep each row, whatever their size."""
    rows = [(k, b"%d" % i, b"r" if k % 2 else b"%d" % i, 10, False) for k in range(6) for i in range(4 if k < 4 else 1)]
    d = spark.createDataFrame(rows, "key long, node binary, root binary, size long, upper boolean")
    for limit in (2, 256):
        got = order_minhash._dealt_words(d, F.lit(1), limit)
        assert {(r.key, bytes(r.node)) for r in got.collect()} == {(k, b"%d" % i) for k in (0, 2) for i in range(4)}
    assert got.count() == 8


def test_whole_texts_are_gathered_once_and_bags_are_not_joined_to_words(spark, monkeypatch, tmp_path):
    """The words of members come from the texts that share a sketch, not from all documents again; each text under
    a word brings its bag along."""
    monkeypatch.setattr(order_minhash, "BLOCK", 8)
    rng, rows, sources, plans = random.Random(14), [], [], []
    draw = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    passage = draw(70)
    for k in range(0, 80, 2):
        own = draw(30)
        rows += [(k, " ".join(own + passage)), (k + 1, " ".join(own[:14] + draw(2) + own[16:] + passage))]
    rows += [(k, " ".join(draw(20))) for k in range(80, 100)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    word_hashes, by_blocks = order_minhash._word_hashes, order_minhash._by_blocks

    def hashed(texts, *more):
        sources.append(set(texts.inputFiles()) & set(docs.inputFiles()))
        return word_hashes(texts, *more)

    def blocks(dealt, columns, *more):
        if "earlier" in columns and "bag" in columns:
            plans.append(dealt._jdf.queryExecution().optimizedPlan().toString())
        return by_blocks(dealt, columns, *more)

    monkeypatch.setattr(order_minhash, "_word_hashes", hashed)
    monkeypatch.setattr(order_minhash, "_by_blocks", blocks)
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 if i < 80 else i for i, _ in rows}
    assert sources and not any(sources)
    assert plans and not any("(node#" in line for p in plans for line in p.split("\n") if "Join" in line)


def test_scattered_edits_up_to_the_declared_similarity_share_a_sketch():
    rng = random.Random(10)
    draw = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    for edits, recall in ((20, 1.0), (40, 0.97)):  # of 200 words: similarity 0.9 and 0.8
        found = 0
        for _ in range(200):
            a = draw(200)
            b = list(a)
            for i in rng.sample(range(200), edits):
                b[i] = draw(1)[0]
            assert order_minhash.similarity(a, b) >= 0.8
            one, two = (order_minhash.sketch(np.array([xxhash.xxh64_intdigest(w) for w in t], np.uint64)) for t in (a, b))
            found += (one == two).any()
        assert found >= recall * 200


def test_bags_rule_no_alignable_pair_out():
    rng = random.Random(8)
    for _ in range(300):
        a = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 60))]
        b = [c for c in a if rng.random() > 0.1] + [rng.choice("abxy") for _ in range(rng.randrange(4))] or ["a"]
        (x, y) = (order_minhash.bag(np.array([hash(w) % 2**64 for w in t], np.uint64)) for t in (a, b))
        may = order_minhash.may_align(x, y[None], len(a), np.array([len(b)]), 0.8)[0]
        assert may or order_minhash.similarity(a, b) is None
    assert not order_minhash.may_align(x, y[None], 1, np.array([9]), 0.8)[0]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    got = {r.node: r.root for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


# 4 ------------------------------------------------------------------------------------------------

def test_packing_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_file())
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = best_fit.pack_documents(documents, queries.tokenizer_file(), keep_ids=True).collect()
    whole, bins = {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        ids = whole.setdefault(r.doc_id, [])
        assert r.start == len(ids) and r.length == len(r.ids) and r.ids_crc32 == __import__("zlib").crc32(np.array(r.ids, "<u4").tobytes())
        ids += r.ids
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert whole == {i: tok.encode(t, add_special_tokens=False).ids + [2] for i, t in texts.items()}
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(map(len, whole.values()))
    assert len(bins) <= 1.03 * -(-total // 1024)


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "a\n\n b", "don't we're  x", "\t\ta b", "ä ö<|endoftext|> z", "a b \n c", "漢字 か な", "x" * 3000, "a" + " " * 5000 + "b", "a  b\u3000\u3000c\x1c\x1d d"])
def test_quick_encoding_gives_the_tokenizers_ids(text):
    from tokenizers import Tokenizer

    t = best_fit._Ids(queries.tokenizer_file())
    assert t.quick is not None
    want = np.array(Tokenizer.from_file(queries.tokenizer_file()).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert t.encode(text) == want


def test_common_lengths_are_ranked_in_parts(spark, documents, monkeypatch):
    """Parts follow the number of pieces; whatever they are, each piece has a place of its own."""
    monkeypatch.setattr(best_fit, "PART_ROWS", 20)
    rows = best_fit.pack_documents(documents.unionByName(documents), queries.tokenizer_file(), capacity=64).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 64


def test_best_two_fit_beats_greedy_and_uses_each_piece_once():
    assert best_fit.plan_bins({6: 1, 3: 1, 2: 2}, 10) == [(1, [6, 2, 2]), (1, [3])]  # greedy alone leaves 6+3 with a gap
    rng = random.Random(1)
    counts = {rng.randrange(1, 101): rng.randrange(1, 50) for _ in range(60)}
    used = Counter()
    for times, lengths in best_fit.plan_bins(counts, 100):
        assert sum(lengths) <= 100
        for n in lengths:
            used[n] += times
    assert used == counts


# 5 ------------------------------------------------------------------------------------------------

def removed(texts, size=200):
    starts = Counter(b[i:i + size] for b in texts for i in range(len(b) - size + 1))
    for b in texts:
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if starts[b[i:i + size]] > 1:
                mask[i:i + size] = True
        yield mask


@pytest.mark.parametrize("block", [suffix_dedup.BLOCK, 3])
def test_repeated_bytes_equal_brute_force(spark, block):
    rng = random.Random(7)
    rand = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    p, q = rand(380), rand(240)
    texts = [rand(150) + p + rand(90), rand(30) + p, q, rand(5) + q + rand(5), "a" * 600, "xyz" * 120 + rand(60), rand(400) + q + q,
             p[50:330] + rand(100), rand(199), "", None, rand(700)] + [rand(rng.randrange(80)) + p + rand(rng.randrange(80)) for _ in range(12)]
    texts += texts[:2]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(d, block=block, keep_text=True).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (b, mask) in enumerate(zip(raw, removed(raw))):
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(b), int(mask.sum()), runs)
        assert got[i].kept == kept and got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_difference_cover():
    d, m = suffix_dedup.difference_cover(), suffix_dedup.COVER**2
    assert {(a - b) % m for a in d for b in d} == set(range(m))


# 6 ------------------------------------------------------------------------------------------------

def test_myers_equals_full_table():
    rng = random.Random(4)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 10)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(18)))
        assert decontaminate.myers(p, t, 20)[0] == min(distance(p, t[i:j]) for i in range(len(t) + 1) for j in range(i, len(t) + 1))
        assert decontaminate.myers(p, t, 20, True)[0] == min(distance(p, t[:j]) for j in range(len(t) + 1))


def test_matches_within_the_budget_and_no_others(spark):
    rng = random.Random(6)
    rand = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n)).strip()
    items = [(k, rand(150)) for k in range(8)]
    budget = [int(decontaminate.ERROR_RATE * len(decontaminate.normalise(t))) for _, t in items]
    rows, want = [], set()
    for k, t in items:
        for extra in (0, budget[k], budget[k] + 6):
            s = list(t)
            for at in rng.sample(range(10, 140), extra):
                s[at] = "#"
            doc = f"{rand(300)} {''.join(s).upper()} {rand(300)}"
            rows.append((len(rows), doc))
            best = min(distance(decontaminate.normalise(t), decontaminate.normalise(doc)[a:a + 150]) for a in range(280, 320)) if extra else 0
            if extra <= budget[k]:
                want.add((len(rows) - 1, k))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK_CHARS, 300):  # one pass, and a block of items at a time
        got = decontaminate.find_matches(d, bench, block_chars=block).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        for r in got:
            assert distance(dict((k, decontaminate.normalise(t)) for k, t in items)[r.item_id], r.passage) == r.distance
    kept = {r.doc_id for r in decontaminate.drop_contaminated(d, bench, block_chars=300).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}


def test_short_items_match_whole_and_items_without_id_stay(spark):
    d = spark.createDataFrame([(1, "So: what  is\nPi? Yes"), (2, "what is pizza"), (3, "what is pj?"), (4, f"q {'long item ' * 4} q")],
                              "doc_id long, text string")
    bench = spark.createDataFrame([(7, "What is pi"), (None, "long item " * 4), (8, " "), (9, None)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance, r.start, r.end, r.passage) for r in decontaminate.find_matches(d, bench).collect())
    assert got == [(1, 7, 0, 4, 14, "what is pi"), (4, None, 0, 2, 41, ("long item " * 4).strip())]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(d, bench).collect()) == [2, 3]


def test_the_budget_alone_decides_how_an_item_matches(spark):
    """Items of 16 to 20 characters: 6 % of 17 is the first whole edit."""
    for n in range(16, 21):
        item = "abcdefghijklmnopqrst"[:n]
        edited = item[:8] + "x" + item[9:]
        d = spark.createDataFrame([(1, item), (2, f"say {item} now"), (3, edited), (4, f"un{item}able")], "doc_id long, text string")
        bench = spark.createDataFrame([(1, item)], "item_id long, text string")
        found = {r.doc_id: r.distance for r in decontaminate.find_matches(d, bench).collect()}
        assert found == ({1: 0, 2: 0} if n < 17 else {1: 0, 2: 0, 3: 1, 4: 0}), n


# 7 ------------------------------------------------------------------------------------------------

def test_shards_are_the_shortest_prefixes_that_fit(spark, documents):
    rows = sharding.hashed(documents).collect()
    sums = Counter()
    for r in rows:
        for k in range(len(r.bits) + 1):
            sums[r.bits[:k]] += r.n_bytes
    got = {r.row: r for r in sharding.assign_shards(documents, 30_000).collect()}
    for r in rows:
        want = next(k for k in range(len(r.bits) + 1) if sums[r.bits[:k]] <= 30_000 or k == len(r.bits))
        assert got[r.row].shard == r.bits[:want] and got[r.row].depth == want and got[r.row].shard_bytes == sums[r.bits[:want]]


def test_one_hot_id_is_split_and_files_are_whole(spark, tmp_path):
    d = spark.createDataFrame([(1, "x" * 100)] * 50 + [(i, f"doc {i}") for i in range(50)], "doc_id long, text string")
    sizes = {r.shard: r.shard_bytes for r in sharding.assign_shards(d, 250).collect()}
    assert max(sizes.values()) <= 250 and sum(sizes.values()) == d.selectExpr("sum(octet_length(text))").first()[0]
    sharding.write_shards(d, str(tmp_path / "s"), 250)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "s")).select("doc_id", "text").collect())) == sorted(map(tuple, d.collect()))


# 8 ------------------------------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = common.read_table(spark, sf, "documents"), common.read_table(spark, sf, "labels")
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = scored[scored.quality == 1], scored[scored.quality == 0]
    assert (good.predicted == 1).mean() > 0.98 and (bad.predicted == 0).mean() > 0.85
    assert scored.score.between(0, 1).all()


def test_trees_without_labels_or_with_one_class():
    x = np.random.default_rng(0).random((50, 3))
    assert (quality.fit_trees(x[:0], np.zeros(0)).score(x) == 0.5).all()
    assert (quality.fit_trees(x, np.ones(50)).score(x) > 0.9).all()


# 9 ------------------------------------------------------------------------------------------------

def test_boilerplate_lines_by_site(spark):
    rows = [(i, f"Menu \nown line {i}\n\nMenu", "a") for i in range(10)] + [(10 + i, f"Menu\nother {i}", "b") for i in range(4)]
    rows += [(20, None, None), (21, "Menu", None), (22, "", "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: (r.text, r.cut) for r in line_dedup.drop_boilerplate(d, ratio=0.5, min_pages=5, dropped="cut").collect()}
    assert out[3] == ("own line 3\n", 2) and out[11] == ("Menu\nother 1", 0)
    assert out[20] == (None, 0) and out[21] == ("Menu", 0) and out[22] == ("", 0)


def test_hosts_of_few_pages_lose_repeated_lines_only(spark):
    """The ratio alone decides, from the second page on: hosts of 1, 2, 4 and 5 pages."""
    rows = [(n, f"Menu\nonly {n} {i}", f"host{n}") for n in (1, 2, 4, 5) for i in range(n)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = line_dedup.drop_boilerplate(d, dropped="cut").collect()
    assert {(r.source, r.cut) for r in out} == {("host1", 0), ("host2", 1), ("host4", 1), ("host5", 1)}
    assert all("only" in r.text for r in out)


# 10 -----------------------------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        if kind == "card":
            twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
            return 16 <= len(d) <= 19 and sum(v - 9 if v > 9 else v for v in twice) % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15

    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(BASE[k], t) if good(k, m.group(0))]


TRICKY = ["a@b.com_c@d.org", "a@b..c x@y.z. 𝒳 é q@w.e", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.1.1.0000000000000000000000000000000000000000001",
          "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111", "+1 (017) 555-7713 +123 ++44 20 7946 0958", "9" * 5000, "a" * 20000, "1-" * 4000 + "1",
          "ä 4111111111111111 and +49 30 1234567", "x@" * 50, "call 212-555-0123 or mail joe (at) example (dot) com", "%._+-@-.-", "5.5@6.6.6.6.6"]


def test_base_spans_equal_the_plain_patterns(spark, documents):
    rng = random.Random(8)
    noise = ["".join(rng.choice("ab1 .-@+()29") for _ in range(200)) for _ in range(150)]
    texts = TRICKY + noise + [r.text for r in documents.collect()]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(pii.detect(d)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (i, t[:200], want, got[i].spans)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(k == w[0] for w in want) for k in pii.KINDS]
        spans = got[i].spans.split(",") if got[i].spans else []
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(spans)


def test_labelers_reliabilities_and_classifier():
    counts = [{"kind": "phone", "regex": 1, "gazetteer": 1, "context": 1, "size": 2, "marks": 1, "base": True, "count": 80},
              {"kind": "phone", "regex": 1, "gazetteer": 1, "context": 0, "size": 2, "marks": 1, "base": True, "count": 60},
              {"kind": "phone", "regex": 0, "gazetteer": 1, "context": 1, "size": 1, "marks": 1, "base": False, "count": 10},
              {"kind": "phone", "regex": -1, "gazetteer": -1, "context": 0, "size": 0, "marks": 0, "base": False, "count": 70}]
    p = pii.label_model(counts)
    assert p["phone", 1, 1, 1] > 0.9 > 0.1 > p["phone", -1, -1, 0]
    w = pii.fit_classifier(counts)
    score = lambda r: sum(w[n] * v for n, v in pii.features(r).items())
    assert score(counts[0]) > 0 > score(counts[3])
    assert pii.label_model([]) == {}
