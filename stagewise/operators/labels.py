"""Unknown labels (P6): proposes the canonical label that a misspelt one stands for.

The value map turns every label it doesn't know into NULL. Here the distinct unknown labels (counted first, so a
label of very many rows is one) are looked up in an index of q-grams of the canonical ones, and candidates
are verified by edit distance. Exactly one nearest label is a proposal; several equally near ones are a reject, as is none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DISTANCE = 2
Q = 2
#: Proposals are broadcast to the rows up to this many.
BROADCAST_LABELS = 100_000

#: Accented letters and their plain ones.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"


def normalised(label: str | Column) -> Column:
    """Lower case, without accents, outer blanks cut and inner ones single. Case, accents and blanks are no edits."""
    c = F.col(label) if isinstance(label, str) else label
    return F.trim(F.regexp_replace(F.translate(F.lower(c), ACCENTED, PLAIN), r"\s+", " "))


def _grams(text: Column, max_distance: int, q: int, index: bool) -> Column:
    """Q-grams of a text, each with how often it stood before, and marks by which short texts meet.

    A text of n characters has n - q + 1 grams and an edit changes q of them at most, so texts within the distance share
    at least one if the longer has ``q * (max_distance + 1)`` characters or more. Shorter ones may share none: they meet by length."""
    n = F.length(text)
    places = F.when(n >= q, F.sequence(F.lit(1), n - F.lit(q) + 1)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(places, lambda i: F.substring(text, i, F.lit(q)))
    first = F.transform(grams, lambda g, i: F.concat(g, F.lit("\0"), F.size(F.filter(F.slice(grams, 1, i), lambda h: h == g)).cast("string")))
    short = n < q * (max_distance + 1)
    lengths = F.array(n) if index else F.sequence(F.greatest(n - max_distance, F.lit(0)), n + max_distance)
    marks = F.transform(lengths, lambda k: F.concat(F.lit("\0"), k.cast("string")))
    return F.concat(first, F.when(short, marks).otherwise(F.array().cast("array<string>")))


def propose_labels(rows: DataFrame, column: str, canonical: DataFrame, max_distance: int = MAX_DISTANCE, q: int = Q) -> DataFrame:
    """One row per distinct label of ``rows`` that ``canonical(label)`` lacks: ``label, rows, proposal, distance, nearest``.

    ``nearest`` holds all canonical labels at the smallest distance (of the normalised texts), if that is at most
    ``max_distance``; ``proposal`` is that one if it is alone, else NULL. NULL labels are no labels."""
    known = canonical.select(F.col("label").alias("canonical")).where(F.col("canonical").isNotNull()).distinct()
    counts = rows.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("label").isNotNull())
    unknown = counts.join(known, counts["label"] == known["canonical"], "left_anti").withColumn("a", normalised("label"))
    index = known.withColumn("b", normalised("canonical"))
    mine = unknown.select("label", "rows", "a", F.explode_outer(_grams(F.col("a"), max_distance, q, False)).alias("gram"))
    theirs = index.select("canonical", "b", F.explode(_grams(F.col("b"), max_distance, q, True)).alias("gram"))
    longer, shorter = F.greatest(F.length("a"), F.length("b")), F.least(F.length("a"), F.length("b"))
    pairs = mine.join(theirs, "gram").groupBy("label", "a", "canonical", "b").agg(F.count(F.lit(1)).alias("shared"))
    enough = (F.col("shared") >= longer - q + 1 - q * max_distance) & (longer - shorter <= max_distance)
    near = pairs.where(enough).withColumn("distance", F.levenshtein("a", "b", max_distance)).where("distance >= 0")
    low = near.groupBy("label").agg(F.min("distance").alias("distance"))
    nearest = near.join(low, ["label", "distance"]).groupBy("label", "distance").agg(F.sort_array(F.collect_list("canonical")).alias("nearest"))
    out = unknown.select("label", "rows").join(nearest, "label", "left")
    return out.select("label", "rows", F.when(F.size("nearest") == 1, F.col("nearest")[0]).alias("proposal"), "distance", "nearest")


def with_proposals(rows: DataFrame, column: str, proposals: DataFrame) -> DataFrame:
    """``rows`` with misspelt labels replaced by their proposals; all others stay as they are."""
    to = proposals.where(F.col("proposal").isNotNull()).select(F.col("label").alias("__label"), F.col("proposal").alias("__to"))
    to = F.broadcast(to) if to.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS else to
    joined = rows.join(to, rows[column] == F.col("__label"), "left")
    return joined.withColumn(column, F.coalesce("__to", column)).select(*rows.columns)


def canonical_labels(spark, labels: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(x,) for x in labels], "label string")
