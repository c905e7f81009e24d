"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    best_fit, decontaminate, license_scan, line_dedup, maxscore, order_minhash, pii, quality, sharding, spotsigs,
    suffix_dedup, token_align, warc,
)
from .common import read_table


def tokenizer_file() -> str:
    """The public vocabulary file that the packing query is defined by."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(read_table(spark, sf_dir, "documents"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file())


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op6_pigeonhole_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents")).drop("row")


def op8_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def op9_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_dedup.drop_boilerplate(docs, dropped="n_dropped").select("doc_id", "source", "n_dropped", "text")


def op10_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(read_table(spark, sf_dir, "documents")))


def op11_diagonal_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_align.align_documents(read_table(spark, sf_dir, "documents"), tokenizer_file(),
                                       public_tokenizers.path("piece_bpe_32k.model"))


def op12_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf_dir, "pages"))


def op13_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.search_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_patience_licenses, op2_spotsigs, op3_order_minhash, op4_best_two_fit, op5_suffix_dedup,
    op6_pigeonhole_decontaminate, op7_extendible_shards, op8_boosted_quality, op9_site_lines, op10_weak_pii,
    op11_diagonal_align, op12_warc_revisits, op13_block_max_search,
)}

SQL = {
    "op13_block_max_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                      lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts FROM documents),
     q AS (SELECT row_number() OVER () AS q, item_id,
                  list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                      lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS ts FROM benchmark),
     qt AS (SELECT q, item_id, unnest(ts) AS t FROM q),
     s AS (SELECT count(*) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM d WHERE len(ts) > 0),
     dt AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
     w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
           FROM (SELECT t, count(*) AS df FROM dt GROUP BY t), s),
     m AS (SELECT r, doc_id, 100 - 90 + (90 * len(ts) * nn) // ll AS m FROM d, s WHERE len(ts) > 0),
     sc AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM qt JOIN w USING (t) JOIN dt USING (t) JOIN m USING (r) GROUP BY q, item_id, r, doc_id),
     k AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INT) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
""",
    "op12_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
     g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT)
                      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g
""",
    "op9_site_lines": f"""
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, source, text,
                      string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
     lines AS (SELECT DISTINCT r, source, trim(u.l, chr(32) || chr(9) || chr(13)) AS k
               FROM pages, unnest(ls) AS u(l) WHERE trim(u.l, chr(32) || chr(9) || chr(13)) <> ''),
     totals AS (SELECT source, count(*) AS n FROM pages GROUP BY source),
     bad AS (SELECT l.source, list(l.k) AS ks
             FROM (SELECT source, k, count(*) AS n FROM lines GROUP BY source, k) l
             JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
             WHERE l.n >= {line_dedup.MIN_PAGES} AND l.n > t.n * CAST({line_dedup.RATIO} AS DOUBLE)
             GROUP BY l.source),
     cleaned AS (SELECT p.doc_id, p.source, p.text, p.ls,
                        list_filter(p.ls, lambda x: NOT coalesce(list_contains(b.ks,
                            trim(x, chr(32) || chr(9) || chr(13))), false)) AS kept
                 FROM pages p LEFT JOIN bad b ON p.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(ls) - len(kept) END AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text
FROM cleaned
""",
}
