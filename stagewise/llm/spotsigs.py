"""Document fingerprints by SpotSigs (op 2).

Every common word (an anchor) starts a chain of the next content words; the set of
chains is the document's fingerprint. Two fingerprints are likened by Jaccard, and
only if their sizes allow the similarity asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, ship_package, text_or_empty

CHAIN = 3  # content words in a chain
MAX_RANGES = 4096  # ranges of ids that are dealt to tasks
#: Common words of the corpus' languages.
ANCHORS = frozenset(
    "a an and are as at be by for from had has have he her his in is it its not of on or she that the their they this "
    "to was were which with you "
    "au aux avec ce dans de des du elle en est et il la le les leur mais ne nous ou par pas pour que qui sa se ses son "
    "sur un une "
    "als am auch auf aus bei das dem den der die ein eine einer er es für hat ich im ist man mit nach nicht sich sie "
    "sind so und vom von war wie zu zum zur "
    "al como con del el ella esta este ha lo los las más mi muy no para pero por sin su sus y ya".split()
)
_STRIP = ".,;:!?\"'()[]{}<>|*#$%&"


def signatures(text: str | None, anchors: frozenset = ANCHORS, chain: int = CHAIN) -> list[int]:
    """Sorted 32-bit hashes of the different spot signatures of a whole text.

    A chain may be shorter at the end of the text. A text without anchors has
    the chains of its content words instead, so only texts without words have
    no signature."""
    content: list[str] = []
    spots: list[tuple[str, int]] = []
    for w in (text or "").lower().split():
        w = w.strip(_STRIP)
        if w in anchors:
            spots.append((w, len(content)))
        elif w:
            content.append(w)
    if not spots:
        spots = [("", i) for i in range(len(content))]
    h = xxhash.xxh32_intdigest
    return sorted({h(" ".join((a, *content[i:i + chain]))) for a, i in spots})


def fingerprint(sigs: list[int]) -> str:
    return "".join([f"{s:08x}" for s in sigs])


def likeness(a: list[int], b: list[int], least: float = 0.0) -> float:
    """Jaccard of two signature sets; 0 without counting if their sizes alone put
    it under ``least``. Two empty sets are alike (1)."""
    x, y = sorted((len(a), len(b)))
    if not y:
        return 1.0
    if x < least * y:
        return 0.0
    common = len(set(a).intersection(b))
    return common / (x + y - common)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of ``following``'s start."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(bucket, i, t, own)``: the documents in ranges of descending id; each
    range also holds, with ``own`` false, the row that follows its last one.

    Bounds are ids that exist, so the row at a bound is the first of its range
    and the follower of the range before; the largest id closes the circle. One
    shuffle of the texts, no global sort and no second pass for the seams. The
    bounds are as many as four times the shuffle partitions, MAX_RANGES at most. A NULL id follows
    all others; rows with the same id follow each other by text."""
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).cast("bigint").alias("i"), text_or_empty(text).alias("t"))
    n = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_RANGES)
    low = -(2**63)
    key = F.coalesce("i", F.lit(low))
    cuts = d.agg(F.percentile_approx(key, [(k + 1) / n for k in range(n)], 100 * n).alias("c"), F.max(key).alias("m")).first()
    bounds = sorted({*(cuts["c"] or []), *([] if cuts["m"] is None else [cuts["m"]])}, reverse=True)
    table = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array(F.lit(low))
    # ranges are numbered from the largest ids on: the row belongs to the last bound >= its id
    bucket = F.size(F.filter(table, lambda b: b >= key)) - 1
    own = d.select(bucket.alias("bucket"), "i", "t", F.lit(True).alias("own"))
    heads = d.where(key.isin(bounds)) if bounds else d
    before = F.pmod(bucket - 1, F.lit(max(len(bounds), 1)))
    return own.unionByName(heads.select(before.alias("bucket"), "i", "t", F.lit(False).alias("own")))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: fingerprints of its text and of its edited text, and how
    like its fingerprint is to the edited text's and to the next document's.

    The next document is that with the next smaller id (after the last: the
    first; alone: itself). NULL and empty texts have the empty fingerprint. A
    task holds two texts at a time."""
    spark = docs.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["bucket", F.col("own").desc(), F.col("i").desc_nulls_last(), "t"]
    rows = with_next(docs, doc_id, text).repartition(n, "bucket").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last own row, which waits for the next one's text
        for batch in batches:
            out = []
            for bucket, i, t, own in zip(*(batch.column(c) for c in range(4))):
                bucket, t = bucket.as_py(), t.as_py()
                if held and held[0] == bucket:
                    sigs = signatures(t) if t != held[2] else held[3]
                    out.append(_row(held, t, sigs))
                    held = (bucket, i.as_py(), t, sigs) if own.as_py() else None
                else:
                    held = (bucket, i.as_py(), t, signatures(t)) if own.as_py() else None
            cols = list(zip(*out)) if out else [[] for _ in SCHEMA.names]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], SCHEMA.names)

    return rows.mapInArrow(run, SCHEMA)


def _row(held: tuple, following: str, sigs: list[int]) -> tuple:
    _, i, t, own = held
    e = edited(t, following)
    changed = signatures(e)
    sha = hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest()
    return i, len(t), sha, fingerprint(own), fingerprint(changed), likeness(own, changed), likeness(own, sigs)


def near_pairs(docs: DataFrame, least: float = 0.8, text: str = "text") -> DataFrame:
    """``(a, b, similarity)``: pairs of different fingerprints with Jaccard >= ``least``.

    ``a`` and ``b`` are fingerprints, each standing for all texts that have it.
    A set is filed under its rarest signatures, as many as a partner must meet,
    and under its own size's partition and the next one: sizes of a similar pair
    differ by less than one partition, so each pair meets in one of them. Pairs
    whose sizes rule them out are pruned before any set is compared."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("array<long>")
    def sigs(texts):
        return texts.map(signatures)

    sets = docs.select(sigs(text_or_empty(text)).alias("s")).where(F.size("s") > 0).distinct()
    sets = materialize(sets.withColumn("node", F.md5(F.array_join(F.col("s").cast("array<string>"), ","))), "spots")
    flat = sets.select("node", F.size("s").alias("n"), F.explode("s").alias("sig"))
    ranked = flat.join(flat.groupBy("sig").agg(F.count(F.lit(1)).alias("df")), "sig")
    rare = ranked.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("o"))
    meet = F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-9)).cast("int") + 1
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(-1.0) / F.log(F.lit(least)) + F.lit(1e-9))
    filed = rare.select("node", "n", part.alias("part"), F.explode(F.slice("o", F.lit(1), meet)).alias("k"))
    filed = filed.select("node", "n", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("k.sig").alias("sig"))
    x, y = filed.alias("x"), filed.alias("y")
    met = x.join(y, ["part", "sig"]).where("x.node < y.node").where(
        F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * F.lit(least))
    pairs = met.select(F.col("x.node").alias("na"), F.col("y.node").alias("nb")).distinct()
    one = sets.select(F.col("node").alias("na"), F.col("s").alias("sa"))
    two = sets.select(F.col("node").alias("nb"), F.col("s").alias("sb"))
    both = pairs.join(one, "na").join(two, "nb")
    common = F.size(F.array_intersect("sa", "sb"))
    sim = common / (F.size("sa") + F.size("sb") - common)
    text_of = lambda c: F.array_join(F.transform(c, lambda v: F.lower(F.lpad(F.hex(v), 8, "0"))), "")
    return both.select(text_of("sa").alias("a"), text_of("sb").alias("b"), sim.alias("similarity")).where(F.col("similarity") >= least)
