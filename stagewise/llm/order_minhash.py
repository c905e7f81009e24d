"""Near-duplicate detection by Order MinHash (op 3).

A sketch samples the ``ELL`` smallest occurrence-labelled word k-mers under its own
hash order and keeps them in the order they have in the text, so two texts share it
only if they share those k-mers and their order. Texts that share a sketch are
candidates; banded alignment of their words decides.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, drop_materialized, materialize, ship_package, text_key, text_or_empty

K = 3  # words in a shingle
ELL = 2  # shingles in a sketch
SKETCHES = 40
BUCKETS = 512  # counters of a text's bag of words
BLOCK = 256  # members of a leftover group that meet those of one other block in one go
BLOCK_BYTES = 16 << 20  # and the bytes of their words
WORD_TABLE = 1 << 20  # counters of words, by hash
EARLIER = 64  # words of a text that a row of a word's group tells
SIMILARITY = 0.8

_MASK = (1 << 64) - 1
_MIX1, _MIX2, _MIX3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.arange(1, 65, dtype=np.uint64) * _MIX3)[:, None]


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def labelled_shingles(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of each k-mer together with how often it stood before in the text."""
    k = min(k, len(hashes))
    h = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        h = _mix(h * _MIX3 + hashes[j:len(hashes) - k + 1 + j])
    order = np.argsort(h, kind="stable")
    new = np.ones(len(h), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    at = np.arange(len(h))
    label = np.empty(len(h), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return _mix(h + label * _MIX1)


def sketch(hashes: np.ndarray, k: int = K, ell: int = ELL, m: int = SKETCHES) -> np.ndarray:
    """``m`` 64-bit sketches of a text given by its words' hashes (one at least)."""
    h = labelled_shingles(hashes, k)
    out = np.zeros(m, np.uint64)
    step = max(1, 2_000_000 // len(h))  # bounds the work array for very long texts
    for a in range(0, m, step):
        v = _mix(h[None, :] ^ _SEEDS[a:min(m, a + step)])
        if len(h) > ell:
            pos = np.sort(np.argpartition(v, ell - 1, axis=1)[:, :ell], axis=1)
        else:
            pos = np.broadcast_to(np.arange(len(h)), (len(v), len(h)))
        s = np.zeros(len(v), np.uint64)
        for j in range(pos.shape[1]):
            s = _mix(s * _MIX3 + h[pos[:, j]])
        out[a:a + len(v)] = s
    return out


def aligned_distance(a: list, b: list, limit: int, ca: Counter | None = None, cb: Counter | None = None) -> int:
    """Edit distance of two sequences if it is at most ``limit``, else ``limit + 1``.

    Banded alignment: a column holds only the cells within ``limit`` of the
    diagonal, as two bit vectors of the steps between neighbours, and moves down
    one row with each element of ``b``. Counts of the elements bound the distance
    from below and spare most unlikes; equal ends are cut off first."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    ca, cb = ca or Counter(a), cb or Counter(b)
    if max((ca - cb).total(), (cb - ca).total()) > limit:
        return limit + 1
    i, j, k = 0, len(a), len(b)
    while i < min(j, k) and a[i] == b[i]:
        i += 1
    while min(j, k) > i and a[j - 1] == b[k - 1]:
        j, k = j - 1, k - 1
    return _banded(a[i:j], b[i:k], limit)


def _banded(a: list, b: list, band: int) -> int:
    m, n = len(a), len(b)
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    mask = (1 << 2 * band + 1) - 1
    top = 1 << 2 * band
    up, down = mask >> band << band, 0  # bit r: the step from row j - band + r - 1 to the next is +1, -1
    score = min(m, band)
    slack = band + n - (m - band)
    for j, w in enumerate(b, 1):
        eq = at.get(w, 0)
        first = j - band - 1
        eq = (eq >> first if first >= 0 else eq << -first) & mask
        diag = ((((eq & up) + up) ^ up) | eq | down) & mask
        right, left = down | (mask & ~(diag | up)), diag & up
        if j + band <= m:
            score += not diag & top
            if score > slack:
                return band + 1
        else:
            row = 1 << m - j + band
            score += bool(right & row) - bool(left & row)
        diag >>= 1
        up, down = left | (mask & ~(diag | right)), diag & right
    return min(score, band + 1)


def similarity(a: list, b: list, least: float = SIMILARITY, ca: Counter | None = None, cb: Counter | None = None) -> float | None:
    """1 - distance / longer length over words, or None if it is under ``least``; ``ca``, ``cb``: their counts, if known."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    limit = int((1 - least) * longer + 1e-9)
    d = aligned_distance(a, b, limit, ca, cb)
    return None if d > limit else 1 - d / longer


def bag(hashes: np.ndarray) -> np.ndarray:
    """Counts of a text's words in ``BUCKETS`` buckets, 255 at most."""
    return np.minimum(np.bincount(hashes % np.uint64(BUCKETS), minlength=BUCKETS), 255).astype(np.uint8)


def may_align(one: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray, least: float) -> np.ndarray:
    """False where bags and sizes rule out that two texts align to ``least``.

    Every word of one bag that the other lacks costs an edit; merged buckets and
    cut counts only lower that number, so no alignable pair is ruled out."""
    limit = ((1 - least) * np.maximum(size, sizes) + 1e-9).astype(np.int64)
    either = np.maximum(others, one).sum(axis=1, dtype=np.int32)
    apart = either - np.minimum(one.sum(dtype=np.int32), others.sum(axis=1, dtype=np.int32))
    return np.maximum(apart, np.abs(sizes - size)) <= limit


def _sketches(texts: DataFrame) -> DataFrame:
    """``(node, size, bag, sigs)`` of ``(node, t)``; texts without words have no sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _WordHash()
        for batch in batches:
            nodes, sizes, bags, sigs = [], [], [], []
            for node, t in zip(batch.column(0), batch.column(1)):
                w = words(t.as_py())
                if w:
                    h = np.array([table[x] for x in w], np.uint64)
                    nodes.append(node.as_py())
                    sizes.append(len(w))
                    bags.append(bag(h).tobytes())
                    sigs.append(sketch(h).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary()),
                 pa.array(sigs, pa.list_(pa.int64()))],
                ["node", "size", "bag", "sigs"])

    return texts.mapInArrow(run, "node binary, size long, bag binary, sigs array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose words align to at least ``least``, written; ``texts(node, t)`` holds each node once."""
    ta = texts.select(F.col("node").alias("a"), F.col("t").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("t").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, s = [], [], []
            for x, y, u, v in zip(*(batch.column(i) for i in range(4))):
                sim = similarity(words(u.as_py()), words(v.as_py()), least)
                if sim is not None:
                    a.append(x.as_py())
                    b.append(y.as_py())
                    s.append(sim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(s, pa.float64())], ["a", "b", "similarity"])

    both = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
    return materialize(both.mapInArrow(run, "a binary, b binary, similarity double"), "links")


def _shared(members: DataFrame) -> DataFrame:
    """``members(key, node, size, ...)`` of groups of more than one, with the group's smallest member ``low`` and its number ``n``."""
    groups = members.groupBy("key").agg(F.min(F.struct("node", "size")).alias("low"), F.count(F.lit(1)).alias("n"))
    return members.join(groups.where("n > 1"), "key")


def _stars(shared: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Candidates ``(a, b)``: every member b of a group with the group's smallest
    member a, unless their sizes or bags of words rule the similarity out."""
    star = shared.where(F.col("node") != F.col("low.node"))
    star = star.where(F.least("size", "low.size") >= F.greatest("size", "low.size") * F.lit(least))
    pairs = star.select(F.col("low.node").alias("a"), F.col("node").alias("b")).distinct()
    one = nodes.select(F.col("node").alias("a"), F.col("size").alias("sa"), F.col("bag").alias("ba"))
    two = nodes.select(F.col("node").alias("b"), F.col("size").alias("sb"), F.col("bag").alias("bb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                bool(may_align(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)[None], m, np.array([n]), least)[0])
                for m, n, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb", "ba", "bb")
    return both.mapInArrow(run, "a binary, b binary")


def _by_size(members: DataFrame, least: float) -> DataFrame:
    """``members`` with their groups cut by text size: texts that may align are of one size class or of neighbouring ones.

    A class is a factor of ``1 / least``. The group of class c holds its members and, as ``upper``, those of class
    c + 1, which meet each other in the group of their own class; so each member is in two groups."""
    own = F.floor(F.log("size") / math.log(1 / least * (1 + 1e-9)))
    m = members.withColumn("__c", own).withColumn("upper", F.explode(F.array(F.lit(False), F.lit(True))))
    return m.withColumn("key", F.xxhash64("key", F.when(F.col("upper"), F.col("__c") - 1).otherwise(F.col("__c")))).drop("__c")


def _dealt(members: DataFrame, weight: Column, limit: int) -> DataFrame:
    """``members(key, node, root, ...)`` of groups of more than one component, each once for every block that
    it meets: ``x <= y`` name two blocks that meet, ``own`` the member's own one. A group within ``limit`` stays whole,
    each member once.

    Blocks are filled up to ``limit`` by ``weight`` on average. Members of a group's largest component
    are in blocks of their own, which meet only those of the others: its members need not be compared with each other, so a
    family of copies beside a few unlike texts costs its size, not its square. Groups of ``upper`` members only are left out."""
    sums = members.groupBy("key", "root").agg(F.sum(weight).alias("w"), F.min("upper").alias("upper"))
    groups = sums.groupBy("key").agg(F.max(F.struct("w", "root")).alias("top"), F.sum("w").alias("all"), F.count(F.lit(1)).alias("n"),
                                     F.min("upper").alias("upper"))
    groups = groups.where("n > 1 AND NOT upper").select(
        "key", F.col("top.root").alias("__top"), (F.col("all") <= limit).alias("__whole"), F.ceil((F.col("all") - F.col("top.w")) / F.lit(limit)).cast("int").alias("__few"),
        F.ceil(F.col("top.w") / F.lit(limit)).cast("int").alias("__many"))
    major, h = F.col("root") == F.col("__top"), F.xxhash64("node")
    own = F.when(major, F.col("__few") + F.pmod(h, F.col("__many"))).otherwise(F.pmod(h, F.col("__few"))).cast("int")
    blocks = F.when(F.col("__whole"), 1).when(major, F.col("__few")).otherwise(F.col("__few") + F.col("__many"))
    meets = F.sequence(F.lit(0), blocks - 1)
    d = members.join(groups, "key").withColumn("own", own).withColumn("__other", F.explode(meets))
    x, y = (F.when(F.col("__whole"), 0).otherwise(f("own", "__other")) for f in (F.least, F.greatest))
    return d.withColumns({"x": x, "y": y}).drop("__other", "__top", "__whole", "__few", "__many")


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The values of a column of lists of numbers."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[i:j] for i, j in zip(ends, ends[1:])]


def _by_blocks(dealt: DataFrame, columns: list[str], schema: str, found) -> DataFrame:
    """``found(rows)`` of every two blocks that meet, in a task of their own at a time. ``rows`` are the
    values of ``columns`` (``own`` and ``node`` first) in the order of ``node``; lists of numbers come as numpy arrays."""
    meet = ["key", "x", "y"]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[pa.RecordBatch]:
            own = {r[0] for r in group}
            parts = [group] if at and (at[1] == at[2] or len(own) > 1) else []
            if at and at[1] == at[2] and len(own) > 1:  # a whole group: the largest component's members meet the others only
                parts.insert(0, [r for r in group if r[0] == at[1]])
            for part in parts:
                out = found(at[0], sorted(part, key=lambda r: r[1])) if len(part) > 1 else []
                cols = list(zip(*out)) if out else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        kinds = [{"binary": pa.binary(), "long": pa.int64(), "double": pa.float64()}[c.split()[1]] for c in schema.split(", ")]
        at, group = None, []
        for batch in batches:
            cols = []
            for c in batch.columns:
                if pa.types.is_list(c.type):
                    cols.append([v.copy() for v in _lists(c)])
                else:
                    cols.append(c.to_pylist())
            for key, x, y, *row in zip(*cols):
                if at != (key, x, y):
                    yield from done()
                    at, group = (key, x, y), []
                group.append(row)
        yield from done()

    tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = dealt.select(*meet, *columns)
    return d.repartition(tasks, *meet).sortWithinPartitions(*meet).mapInArrow(run, schema)


def _open_pairs(own: np.ndarray, upper: np.ndarray, roots: np.ndarray, sizes: np.ndarray, bags: np.ndarray, least: float):
    """``(p, q)``: each place p with the later places of other components whose sizes and bags let them align.
    Pairs within a block meet where the block meets itself, those of two ``upper`` members in another group.
    ``roots`` may change meanwhile."""
    two = own.min() != own.max()
    for p in range(len(own) - 1):
        q = np.flatnonzero((roots[p + 1:] != roots[p]) & ~(upper[p + 1:] & upper[p])) + p + 1
        if two:
            q = q[own[q] != own[p]]
        q = q[np.minimum(sizes[q], sizes[p]) >= least * np.maximum(sizes[q], sizes[p])]
        if len(q):
            q = q[may_align(bags[p], bags[q], sizes[p], sizes[q], least)]
        if len(q):
            yield p, q


def _numbered(roots: list[bytes]) -> np.ndarray:
    return np.unique(np.array([r.hex() for r in roots]), return_inverse=True)[1]


def _undecided(members: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Members ``(key, node)`` of a group that may align with one of another component in it, judged by
    sizes and bags of words. A pair counts in the first group that it shares, and not with the group's
    smallest member, which the star has tried. Groups are of ``BLOCK`` members at most; rows are members, not pairs."""

    def found(key: int, group: list[list]) -> list[tuple]:
        own, node, upper, root, size, bags, band, sigs, low = zip(*group)
        own, upper, size, sigs = np.array(own), np.array(upper), np.array(size), np.stack(sigs)[:, :band[0]]
        bags = np.frombuffer(b"".join(bags), np.uint8).reshape(len(group), BUCKETS)
        needed = np.zeros(len(group), bool)
        for p, q in _open_pairs(own, upper, _numbered(root), size, bags, least):
            if node[p] != low[p]:  # rows are in the order of nodes, so only p can be the smallest
                q = q[~(sigs[q] == sigs[p]).any(axis=1)]
                needed[q] = True
                needed[p] |= len(q) > 0
        return [(key, node[i]) for i in np.flatnonzero(needed)]

    columns = ["own", "node", "upper", "root", "size", "bag", "band", "sigs", "low"]
    dealt = _dealt(members, F.lit(1), BLOCK).join(nodes.select("node", "bag", "sigs"), "node")
    return _by_blocks(dealt, columns, "key long, node binary", found).distinct()


def _word_hashes(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``(node, hashes)`` of those of ``texts(node, t)`` whose node is among ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _WordHash()
        for batch in batches:
            start, held = 0, []
            for i, t in enumerate(batch.column(1)):
                held.append(np.array([table[x] for x in words(t.as_py())], np.uint64).view(np.int64))
                if sum(map(len, held)) > 1 << 18 or i == len(batch) - 1:  # texts may be very long
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(held)), pa.array(held, pa.list_(pa.int64()))],
                                                     ["node", "hashes"])
                    start, held = i + 1, []

    return texts.join(ids.select("node").distinct(), "node", "left_semi").mapInArrow(run, "node binary, hashes array<long>")


def _aligned_links(least: float, rule=None):
    """``found`` of rows ``(own, node, upper, root, size, hashes, ...)``: links that join their components. ``rule`` of
    the further columns, if given, tells by places which pairs count."""

    def found(key: int, group: list[list]) -> list[tuple]:
        own, node, upper, root, size, hashes, *more = zip(*group)
        own, upper, size, roots = np.array(own), np.array(upper), np.array(size), _numbered(root)
        bags = np.stack([bag(h.view(np.uint64)) for h in hashes])
        counts = rule(*more) if rule else lambda p, k: True
        lists: dict[int, tuple[list, Counter]] = {}

        def held(i: int) -> tuple[list, Counter]:
            if i not in lists:
                w = hashes[i].tolist()
                lists[i] = w, Counter(w)
            return lists[i]

        out = []
        for p, q in _open_pairs(own, upper, roots, size, bags, least):
            for k in q:
                if roots[k] != roots[p] and counts(p, k):
                    (a, ca), (b, cb) = held(p), held(k)
                    sim = similarity(a, b, least, ca, cb)
                    if sim is not None:
                        out.append((node[p], node[k], sim))
                        roots[roots == roots[k]] = roots[p]
            lists.pop(p, None)
        return out

    return found


def _room() -> Column:
    return F.greatest(F.lit(BLOCK_BYTES // BLOCK), F.col("size") * 8)  # BLOCK members, fewer if they are long


_LINK = "a binary, b binary, similarity double"


def _by_sketch(members: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links of :func:`_across` for groups that are compared member by member.

    The members that bags leave undecided get their words (64-bit hashes) and meet again, block by
    block, in blocks bounded by bytes. A task aligns two members only while their components are
    apart, so it returns at most as many links as it has components, less one."""
    undecided = materialize(_undecided(members, nodes, least), "undecided")
    hashed = materialize(_word_hashes(texts, undecided), "words")
    dealt = _dealt(undecided.join(members, ["key", "node"]), _room(), BLOCK_BYTES).join(hashed, "node")
    columns = ["own", "node", "upper", "root", "size", "hashes"]
    links = materialize(_by_blocks(dealt, columns, _LINK, _aligned_links(least)), "links")
    for df in (undecided, hashed):
        drop_materialized(df)
    return links


def _word_levels(texts: DataFrame) -> np.ndarray:
    """How common words are in ``texts(node, root, size, hashes)``, by the last bits of their hashes: 0 for words of one
    component only, else by the logarithm of the number of texts. Tasks hand on counters, ``WORD_TABLE`` at most."""
    size, part = WORD_TABLE, max(1, WORD_TABLE // 16)

    def table() -> list[np.ndarray]:
        return [np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = table()
        for batch in batches:
            for h, root in zip(_lists(batch.column(1)), batch.column(0).to_pylist()):
                at, r = np.unique(h & (size - 1)), int.from_bytes(root[:8], "big") >> 1
                n[at] += 1
                low[at], high[at] = np.minimum(low[at], r), np.maximum(high[at], r)
        for k in range(0, size, part):
            at = np.flatnonzero(n[k:k + part]) + k
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k]), *(pa.array([v], pa.list_(pa.int64())) for v in (at, n[at], low[at], high[at]))],
                    ["part", "at", "n", "low", "high"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = table()
        for batch in batches:
            for at, m, lo, hi in zip(*(_lists(c) for c in batch.columns[1:])):
                n[at] += m
                low[at], high[at] = np.minimum(low[at], lo), np.maximum(high[at], hi)
        level = np.where(low < high, np.minimum(1 + 8 * np.log2(np.maximum(n, 1)), 255), 0).astype(np.uint8)
        for k in np.unique(np.flatnonzero(level) // part * part).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([level[k:k + part].tobytes()], pa.binary())], ["part", "level"])

    lists = "part long, at array<long>, n array<long>, low array<long>, high array<long>"
    counted = texts.select("root", "hashes").mapInArrow(count, lists)
    levels = np.zeros(size, np.uint8)
    for k, level in counted.repartition(16, "part").mapInArrow(merge, "part long, level binary").collect():
        levels[k:k + part] = np.frombuffer(level, np.uint8)
    return levels


def _rare_words(texts: DataFrame, least: float) -> DataFrame:
    """``(key, node, root, size, upper, earlier, bag, keys)``: ``texts(node, root, size, hashes, keys)``, each under the words
    by which it may meet texts of other components.

    Two texts that align lack at most ``1 - least`` of the longer one's words in each other, so with all words in one
    order, the first word that they share is among each one's first ``(1 - least) * size + 1``. The order begins with
    words of one component only, which no two components share, and goes on from rare to common. ``earlier`` are
    the words of the row's text before ``key``, the first ``EARLIER`` of them."""
    levels = texts.sparkSession.sparkContext.broadcast(_word_levels(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            node, root, size = (batch.column(i).to_pylist() for i in range(3))
            keys = batch.column(4)
            for i, h in enumerate(_lists(batch.column(3))):
                v = level[h & (len(level) - 1)]
                first = np.lexsort((h, v))[:int((1 - least) * len(h) + 1e-9) + 1]
                w = list(dict.fromkeys(h[first[v[first] > 0]].tolist()))
                own = bag(h.view(np.uint64)).tobytes()
                for k in range(0, len(w), 1024):
                    m = len(w[k:k + 1024])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(w[k:k + m], pa.int64()), pa.array([node[i]] * m, pa.binary()), pa.array([root[i]] * m, pa.binary()),
                         pa.array([size[i]] * m, pa.int64()), pa.array([False] * m),
                         pa.array([w[:min(j, EARLIER)] for j in range(k, k + m)], pa.list_(pa.int64())),
                         pa.array([own] * m, pa.binary()), keys.take(pa.array([i] * m))],
                        ["key", "node", "root", "size", "upper", "earlier", "bag", "keys"])

    rows = texts.select("node", "root", "size", "hashes", "keys")
    return rows.mapInArrow(
        run, "key long, node binary, root binary, size long, upper boolean, earlier array<long>, bag binary, keys array<long>")


def _first_meeting(keys: tuple, earlier: tuple):
    """Tells of two places whether they share a sketch's group and no word before this group's."""
    sets: dict[int, tuple[set, set]] = {}

    def of(i: int) -> tuple[set, set]:
        if i not in sets:
            sets[i] = set(keys[i].tolist()), set(earlier[i].tolist())
        return sets[i]

    def counts(p: int, k: int) -> bool:
        (a, x), (b, y) = of(p), of(k)
        return not a.isdisjoint(b) and x.isdisjoint(y)

    return counts


def _dealt_words(rows: DataFrame, weight: Column, limit: int) -> DataFrame:
    """``rows`` of words' groups of more than one component, whole up to ``limit`` by ``weight``, larger ones as by :func:`_dealt`."""
    groups = rows.groupBy("key").agg(F.sum(weight).alias("w"), F.min("root").alias("one"), F.max("root").alias("other"))
    groups = groups.where("one < other").select("key", (F.col("w") > limit).alias("large"))
    met = rows.join(groups, "key")
    whole = met.where("NOT large").withColumns({c: F.lit(0) for c in ("own", "x", "y")})
    return whole.unionByName(_dealt(met.where("large"), weight, limit)).drop("large")


def _by_words(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links of :func:`_across` for large groups, all at once: their members meet under the rare words that they
    share (see :func:`_rare_words`), so rows grow with the texts' lengths, not with the square of a group's size.
    A word's group that is large itself is dealt into blocks.

    As in :func:`_by_sketch`, bags leave some members undecided, which meet again with their words."""
    one = members.groupBy("node").agg(F.first("root").alias("root"), F.first("size").alias("size"), F.collect_set("key").alias("keys"))
    held = materialize(one, "wide")
    hashed = materialize(_word_hashes(texts, held).join(held, "node"), "words")
    rows = materialize(_rare_words(hashed, least), "rare")

    def found(key: int, group: list[list]) -> list[tuple]:
        own, node, upper, root, size, bags, keys, earlier = zip(*group)
        bags = np.frombuffer(b"".join(bags), np.uint8).reshape(len(group), BUCKETS)
        counts = _first_meeting(keys, earlier)
        needed = np.zeros(len(group), bool)
        for p, q in _open_pairs(np.array(own), np.array(upper), _numbered(root), np.array(size), bags, least):
            q = [k for k in q if counts(p, k)]
            needed[q] = True
            needed[p] |= len(q) > 0
        return [(key, node[i]) for i in np.flatnonzero(needed)]

    columns = ["own", "node", "upper", "root", "size", "bag", "keys", "earlier"]
    needed = _by_blocks(_dealt_words(rows, F.lit(1), BLOCK), columns, "key long, node binary", found).distinct()
    undecided = materialize(needed.join(rows.drop("bag"), ["key", "node"]), "undecided")
    columns = ["own", "node", "upper", "root", "size", "hashes", "keys", "earlier"]
    dealt = _dealt_words(undecided, _room(), BLOCK_BYTES).join(hashed.select("node", "hashes"), "node")
    links = materialize(_by_blocks(dealt, columns, _LINK, _aligned_links(least, _first_meeting)), "links")
    for df in (held, hashed, rows, undecided):
        drop_materialized(df)
    return links


def _across(members: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b, similarity)`` that join the components of ``members(key, upper, band, node, size, root, low)``: of any two
    texts with a common key that align, both are in one component afterwards. Groups of up to ``BLOCK`` members are compared
    member by member, those of larger ones by their rare words."""
    groups = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("one"), F.max("root").alias("other"), F.min("upper").alias("upper"))
    groups = groups.where("one < other AND NOT upper").select("key", (F.col("n") > BLOCK).alias("wide"))
    apart = materialize(members.join(groups, "key"), "apart")
    links = _by_sketch(apart.where("NOT wide"), nodes, texts, least)
    wide = apart.where("wide")
    if not wide.isEmpty():
        links = links.unionByName(_by_words(wide, texts, least))
    drop_materialized(apart)
    return links


def near_links(docs: DataFrame, text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Verified links ``(a, b, similarity)`` between different texts, by text key.

    Equal texts are one node. Texts that share a sketch form a group; each
    member is aligned with the group's smallest node, so a group of thousands of
    near copies costs thousands of alignments, not millions. Then all members
    of a group that these links leave in different components are compared with
    each other, linked to the smallest node or not: their bags of words rule most
    pairs out, the rest is aligned until their components are joined. In groups of more than
    ``BLOCK`` members only those meet that share a rare word, as all that align do. So any two texts
    that share a sketch and align end up in one component, though not each such pair
    inside one gets a link.
    No member is dropped for the size of its group. Two texts whose shingle sets have similarity J share
    a sketch with chance about J**2. Edits scattered over a text cost most
    shingles: at word similarity 0.8 J is about 0.34, and about 1 % of such pairs
    share none of the 40 sketches; at 0.9 (J 0.57) less than one in a million."""
    spark = docs.sparkSession
    ship_package(spark)
    t = docs.select(text_key(text).alias("node"), text_or_empty(text).alias("t"))
    one = _sketches(t).groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "bag", "sigs")])
    nodes = materialize(one, "sketches")
    sigs = nodes.select("node", "size", F.posexplode("sigs").alias("band", "sig"))
    members = sigs.select(F.xxhash64("band", "sig").alias("key"), "band", "node", "size")
    shared = materialize(_shared(members), "shared")
    texts = materialize(t.join(shared.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("t").alias("t")), "texts")
    star = materialize(_stars(shared, nodes, least), "candidates")
    links = _verified(star, texts, least)
    rest = shared.where("n > 2").join(connected_components(links), "node", "left")
    rest = rest.select("key", "band", "node", "size", F.col("low.node").alias("low"), F.coalesce("root", "node").alias("root"))
    rest = materialize(_by_size(rest, least), "members")
    more = _across(rest, nodes, texts, least)
    for df in (shared, texts, star, nodes, rest):
        drop_materialized(df)
    return links.unionByName(more)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, class_id, n_links)``.

    The class is the component of equal texts and verified links; its id is its
    smallest doc_id (NULL if all are NULL). ``n_links`` counts the verified
    links of the row's text to other texts: those to or from the smallest text of
    a sketch group, and those that join the components that these make; pairs inside a
    component that were never tried don't count. Equal texts are no links. All empty
    and NULL texts are equal. Repeated rows give repeated rows."""
    classes, links = _classes(docs, doc_id, text, least)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("node"))
    return (
        keyed.join(classes, "node").join(degree, "node", "left")
        .select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    )


def _classes(docs: DataFrame, doc_id: str, text: str, least: float) -> tuple[DataFrame, DataFrame]:
    """``(node, class_id, keep)`` for every text, and the links; ``keep`` marks
    the one text whose first row (by doc_id, NULL last) stands for its class."""
    links = materialize(near_links(docs, text, least).select("a", "b").distinct(), "links")
    ids = docs.groupBy(text_key(text).alias("node")).agg(F.min(doc_id).alias("first_id"))
    roots = connected_components(links)
    rooted = ids.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "classes")
    order = F.struct(F.col("first_id").isNull(), F.col("first_id"), F.col("node"))
    best = rooted.groupBy("root").agg(F.min(order).alias("best"))
    classes = rooted.join(best, "root").select(
        "node", F.col("best.first_id").alias("class_id"), (F.col("best.node") == F.col("node")).alias("keep"))
    return classes, links


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest doc_id (NULL
    last; of equal texts under the same id any one row). All columns stay."""
    classes, _ = _classes(docs, doc_id, text, least)
    kept = classes.where("keep").select(F.col("node").alias("__node"), F.col("class_id").alias("__id"))
    row = F.struct(*[docs[c] for c in docs.columns])
    keyed = docs.select(text_key(docs[text]).alias("__node"), docs[doc_id].alias("__id"), row.alias("row"))
    first = keyed.join(kept, (keyed["__node"] == kept["__node"]) & keyed["__id"].eqNullSafe(kept["__id"]), "left_semi")
    return first.groupBy("__node").agg(F.first("row").alias("row")).select("row.*")
