"""Token alignment, WARC revisits and Block-Max MaxScore against brute force, and their odd inputs."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stagewise.llm import common, maxscore, queries, token_align, warc

from .test_operators import odd

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = ["a", "  a", " a b  c ", "x\n\ny \n z", "<|endoftext|> <s> </s>", "▁ a", "a▁b", "\x00a\x00 b", "é ï 中文 字", "\x1c a\x1d b", " a   b",
             "　x y", "a\t b", "🙂 🙂🙂", "don't 's", " ", "\n", "\r\n a", "a \x85 b", "1 2 33", "", None, "ab" * 4000, " " * 5000 + "x"]


# 11 -----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def both():
    return token_align._Both(A, B)


def test_stretches_on_random_ends():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randint(1, 200)
        dense = rng.random()
        ends = [[i for i in range(1, n) if rng.random() < dense or i % 40 < 25] + [n] for _ in range(2)]
        common_ends = sorted(set(ends[0]) & set(ends[1]))
        a, b = (np.array(e) for e in ends)
        cuts_a, cuts_b = token_align.cuts(a, b)
        assert cuts_a.tolist() == [ends[0].index(e) + 1 for e in common_ends]
        assert cuts_b.tolist() == [ends[1].index(e) + 1 for e in common_ends]
        i, j = token_align.links(a, b, cuts_a, cuts_b)
        starts = [[0, *e[:-1]] for e in ends]
        want = [(x, y) for x in range(len(ends[0])) for y in range(len(ends[1]))
                if starts[0][x] < ends[1][y] and starts[1][y] < ends[0][x]]
        assert sorted(zip(i.tolist(), j.tolist())) == want


def test_a_long_one_to_one_stretch_takes_few_steps():
    class Counted(list):
        slices = 0

        def __getitem__(self, k):
            Counted.slices += isinstance(k, slice)
            return list.__getitem__(self, k)

    ends = Counted(range(1, 100_001))
    assert token_align.stretches(ends, list(ends)) == [0, 100_000, 0, 100_000]
    assert Counted.slices < 40


def brute_alignment(both, slow, text):
    a = slow.encode(" " + text, add_special_tokens=False).ids if text else []
    b = both.sp.encode(text) if text else []
    spans = []
    for ids, table in ((a, both.bytes_a), (b, both.bytes_b)):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i]), i))
            at = out[-1][1]
        spans.append(out)
    if not text or any(b"".join(t[i] for i in ids) != (" " + text).encode() for ids, t in ((a, both.bytes_a), (b, both.bytes_b))):
        return 0, 0, 0, [], ""
    shared = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
    sides = []
    for s in spans:
        groups, now = [], []
        for _, e, i in s:
            now.append(str(i))
            if e in shared:
                groups.append(",".join(now))
                now = []
        sides.append(groups)
    links, y = [], 0
    for s, e, i in spans[0]:
        while spans[1][y][1] <= s:
            y += 1
        z = y
        while z < len(b) and spans[1][z][0] < e:
            links.append((i, spans[1][z][2]))
            z += 1
    text_ = ";".join(f"{x}|{y}" for x, y in zip(*sides))
    return len(a), len(b), len(shared), links, hashlib.sha256(text_.encode()).hexdigest()


def brute_rows(both, rows):
    slow = Tokenizer.from_file(A)
    slow.encode_special_tokens = True
    found = [(i, *brute_alignment(both, slow, t)) for i, t in rows]
    held = Counter(p for f in found for p in set(f[4]))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return sorted(((i, n_a, n_b, g, len(ls), sum(held[p] == top[p[0]] for p in ls), sum(held[p] for p in ls), d)
                   for i, n_a, n_b, g, ls, d in found), key=str)


def test_alignment_equals_brute_force(spark, both):
    rows = [(r.doc_id, r.text) for r in common.read_table(spark, SF, "documents").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a b c"), (1, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = token_align.align_documents(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_rows(both, rows)


def test_chunks_of_few_links_give_the_same(spark, both, monkeypatch):
    monkeypatch.setattr(token_align, "CHUNK_LINKS", 300)
    rows = [(r.doc_id, r.text) for r in common.read_table(spark, SF, "documents").limit(40).collect()]
    chunks = token_align.aligned_chunks(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), A, B)
    assert chunks.select("chunk").distinct().count() > 3  # several in one task
    assert chunks.where("is_doc").count() == 40


def test_alignment_of_odd_rows(spark):
    d = odd(spark)
    out = token_align.align_documents(d, A, B).collect()
    assert len(out) == d.count()
    assert {(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out if r.doc_id in (2, 3)} == {(0,) * 6 + ("",)}
    assert token_align.align_documents(d.limit(0), A, B).collect() == []


# 12 -----------------------------------------------------------------------------------------------

def brute_pages(pages):
    first = {}
    for i, h in pages:
        first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, h in pages:
        body = (h or "").encode()
        o = first[h or ""]
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), *(("response", None) if i == o else ("revisit", o))))
    return sorted(out, key=str)


def test_pages_equal_brute_force(spark):
    rows = [(r.page_id, r.html) for r in common.read_table(spark, SF, "pages").collect()]
    rows += [(10_000 + i, "<p>same</p>") for i in range(300)] + [(20_000 + i, None if i % 2 else "") for i in range(40)]
    rows += [(30_000, "x" * 3_000_000), (30_001, "x" * 3_000_000), (30_002, "a\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n\r\n")]
    random.Random(1).shuffle(rows)
    pages = spark.createDataFrame([(i, f"http://h/{i}?a b\r\nWARC-Type: x", h) for i, h in rows], "page_id long, url string, html string")
    got = warc.archive_pages(pages.repartition(5))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_pages(rows)


def test_archives_are_valid_and_smaller(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "<p>" + "ab" * 5000 * (1 + i % 3)) for i in range(60)], "page_id long, url string, html string")
    raw = warc.write_pages(pages.coalesce(2), str(tmp_path / "raw"), limit=2000)
    assert raw.count() > 2  # closed by their size
    final = warc.deduplicate(spark, raw, str(tmp_path / "out"))
    assert final.agg(F.sum("n_bytes")).first()[0] < raw.agg(F.sum("n_bytes")).first()[0]
    ids, kinds = [], Counter()
    for r in final.collect():
        data = gzip.open(r.file).read()  # members in a row are a valid gzip file
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n") and rest[int(fields["Content-Length"]):][:4] == b"\r\n\r\n"
            data = rest[int(fields["Content-Length"]) + 4:]
            ids.append(fields["WARC-Record-ID"])
            kinds[fields["WARC-Type"]] += 1
            if fields["WARC-Type"] == "revisit":
                assert fields["WARC-Profile"] == warc.PROFILE and fields["WARC-Refers-To-Target-URI"].startswith("http://h/")
    assert len(ids) == len(set(ids)) and kinds["response"] == 3 and kinds["revisit"] == 57
    # payloads of revisits come back from the response they refer to
    pages_back = warc.resolve(warc.read_headers(final, payload=True)).select("page_id", "payload").collect()
    assert {r.page_id: bytes(r.payload).decode() for r in pages_back} == {r.page_id: r.html for r in pages.collect()}


def test_archives_with_revisits_are_resolved_again(spark, tmp_path):
    """Deduplicated archives of two crawls, put together: revisits of both meet one response."""
    crawls = []
    for n in range(2):
        rows = [(100 * n + i, f"http://h/{n}/{i}", f"<p>{i % 4}") for i in range(20)]
        raw = warc.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / f"raw{n}"))
        crawls.append(warc.deduplicate(spark, raw, str(tmp_path / f"one{n}")))
    both = warc.deduplicate(spark, crawls[1].unionByName(crawls[0]), str(tmp_path / "both"))
    out = warc.resolve(warc.read_headers(both)).collect()
    assert len(out) == 40 and sorted(r.page_id for r in out if r.record_type == "response") == [0, 1, 2, 3]
    assert all(r.refers_to == r.page_id % 4 for r in out if r.record_type == "revisit")


def test_payload_that_is_not_its_headers_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    raw = warc.write_pages(pages, str(tmp_path / "raw"))
    file = raw.first().file
    name = file.removeprefix("file:")
    data = gzip.open(name).read().replace(b"abc", b"abd")
    open(name, "wb").write(gzip.compress(data))
    with pytest.raises(Exception, match="WARC record|isn't that of its headers"):
        warc.read_headers(raw).collect()


def test_small_payloads_may_stay_whole(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "v", "ab"), (3, "w", "abcd"), (4, "x", "abcd")], "page_id long, url string, html string")
    out = warc.archive_pages(pages, least_bytes=3).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in out} == {
        1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, original string, file string, offset string, __n string"
    rows = [(None, None, None), (None, "u", "x"), (5, None, "x"), (5, None, "x"), (7, "", ""), (8, "u", "x"), (8, "u", "y")]
    pages = spark.createDataFrame([r + (None,) * 4 for r in rows], schema)
    out = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_pages(pages).collect()), key=str)
    assert out == sorted([(None, 0, "revisit", 7), (7, 0, "response", None), (None, 1, "revisit", 5), (5, 1, "response", None),
                          (5, 1, "revisit", 5), (8, 1, "revisit", 5), (8, 1, "response", None)], key=str)
    assert warc.archive_pages(pages.limit(0)).collect() == []


# 13 -----------------------------------------------------------------------------------------------

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute_search(docs, items, k):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(plain_terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "WINDOW", 16)
    docs = [(r.doc_id, r.text) for r in common.read_table(spark, "/root/testdata/sf0.01", "documents").limit(500).collect()]
    docs += [(900_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "x y z 1 2 33"), (None, "ÀB à"), (7, "x Y"), (7, "x y")]
    items = [(r.item_id, r.text) for r in common.read_table(spark, SF, "benchmark").collect()]
    items += [(1000, "X y z"), (1000, "the 33 ÀB"), (None, "a b"), (1001, ""), (1002, None), (1003, "nowhereatall"), (1004, docs[0][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    q = spark.createDataFrame(items, "item_id long, text string")
    index = maxscore.build_index(d, shard_bytes=30_000)
    assert index.select("shard").distinct().count() > 8
    want = brute_search(docs, items, 10)
    got = maxscore.search(index, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    # queries in many blocks; a smaller k
    assert sorted(map(tuple, maxscore.search(index, q, query_bytes=700).collect()), key=str) == want
    assert sorted(map(tuple, maxscore.search(index, q, 3).collect()), key=str) == brute_search(docs, items, 3)


def test_blocks_round_trip_and_their_bounds():
    rng = np.random.default_rng(5)
    docs = 3000
    lens = rng.integers(1, 70_000, docs)
    lists = [np.sort(rng.choice(docs, n, replace=False)) for n in (1, 127, 128, 129, 1500, 3000)]
    term = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    doc = np.concatenate(lists)
    tf = np.where(rng.random(len(doc)) < 0.01, rng.integers(1, 100_000, len(doc)), rng.integers(1, 5, len(doc)))
    p = maxscore.pack_postings(term, doc, tf, lens)
    scoring = maxscore.Scoring(docs, int(lens.sum()))
    norms = scoring.norms(lens)
    for t, want in enumerate(lists):
        b = slice(p["blocks"][t - 1] if t else 0, p["blocks"][t])
        k = slice(p["pairs"][t - 1] if t else 0, p["pairs"][t])
        row = {"last": p["last"][b], "df": p["df"][t], "widths": p["widths"][b].tobytes(), "n_pairs": p["n_pairs"][b], "pair_tf": p["pair_tf"][k],
               "pair_len": p["pair_len"][k], "postings": p["postings"][p["bytes"][t - 1] if t else 0:p["bytes"][t]].tobytes()}
        postings = maxscore.Postings(row, norms, scoring)
        got_doc, part = postings.span(0, docs)
        assert got_doc.tolist() == want.tolist()
        own = tf[term == t]
        assert part.tolist() == scoring.part(own, norms[want]).tolist()
        assert postings.top.tolist() == [part[a:a + maxscore.BLOCK].max() for a in range(0, len(part), maxscore.BLOCK)]
        lo, hi = 700, 1400
        assert postings.span(lo, hi)[0].tolist() == [x for x in want if lo <= x < hi]


def test_blocks_of_non_essential_lists_stay_compressed():
    """A common word's list is opened only where candidates of the rare word need it."""
    docs = 200_000
    lens = np.full(docs, 50)
    rare, common_ = np.arange(50_000, 50_040), np.arange(docs)
    term = np.repeat([0, 1], [len(rare), docs])
    p = maxscore.pack_postings(term, np.concatenate([rare, common_]), np.ones(len(term), np.int64), lens)
    scoring = maxscore.Scoring(docs, docs * 50)
    lists = []
    for t in range(2):
        b, k = (slice(p[n][t - 1] if t else 0, p[n][t]) for n in ("blocks", "pairs"))
        row = {"last": p["last"][b], "df": p["df"][t], "widths": p["widths"][b].tobytes(), "n_pairs": p["n_pairs"][b], "pair_tf": p["pair_tf"][k],
               "pair_len": p["pair_len"][k], "postings": p["postings"][p["bytes"][t - 1] if t else 0:p["bytes"][t]].tobytes()}
        postings = maxscore.Postings(row, scoring.norms(lens), scoring)
        lists.append((scoring.weight(int(p["df"][t])) * postings.most if t == 0 else postings.most, scoring.weight(int(p["df"][t])) if t == 0 else 1, postings))
    lists.sort(key=lambda x: x[0])
    least = lists[0][0] + 1
    doc, _ = maxscore.rank_window(lists, 0, docs, least)
    assert doc.tolist() == rare.tolist()
    assert len(lists[0][2].open) == 1 and len(lists[0][2].last) > 1500


def test_odd_documents_and_empty_tables(spark):
    d = odd(spark)
    q = spark.createDataFrame([(1, "a f", "x"), (2, None, "x"), (None, "w7", "x")], "item_id long, text string, score string")
    got = sorted(map(tuple, maxscore.search_documents(d, q).collect()), key=str)
    want = brute_search([(r.doc_id, r.text) for r in d.collect()], [(1, "a f"), (2, None), (None, "w7")], 10)
    assert got == want
    assert maxscore.search_documents(d.limit(0), q).collect() == []
    assert maxscore.search_documents(d, q.limit(0)).collect() == []


def test_norms_of_very_large_corpora():
    s = maxscore.Scoring(10**12, 10**15)
    lens = np.array([1, 10**9, 5 * 10**9])
    assert s.norms(lens).tolist() == [10 + 90 * int(n) * 10**12 // 10**15 for n in lens]


@pytest.mark.parametrize("key", ["op12_warc_revisits", "op13_block_max_search"])
def test_sql(spark, key):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[key](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[key]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
