"""Proposals for unknown labels against brute force over all pairs."""

import random
import unicodedata

import pytest

from stagewise.operators import labels as lb
from stagewise.schemas import STAGES


def _plain(s):
    s = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))
    return " ".join(s.split())


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def _brute(labels, canonical, most):
    out = []
    for label in {x for x in labels if x is not None} - set(canonical):
        near = {c: _distance(_plain(label), _plain(c)) for c in canonical}
        best = min(near.values(), default=99)
        names = sorted(c for c, d in near.items() if d == best) if best <= most else None
        out.append((label, labels.count(label), names[0] if names and len(names) == 1 else None, best if names else None, names))
    return sorted(out)


@pytest.mark.parametrize("most,q", [(0, 2), (1, 2), (2, 2), (2, 3), (3, 2)])
def test_proposals_equal_brute_force(spark, most, q):
    rng = random.Random(most * 10 + q)
    canonical = ["a", "ab", "abc", "abcd", "bcda", "aaaa", "Firma", "Firmas", "Validacion de datos", "Confirmacion de datos", "ññ"]
    labels = [None, "", " ", "Ábc", "FIRMA", "firmo", "válidación  de datos ", "zzzzzzzz", "aaaaaaa"]
    for _ in range(150):
        s = list(rng.choice(canonical))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(s) + 1)
            s[i:i + rng.randrange(2)] = rng.choice(["", "x", "a", "b", " "])
        labels.append("".join(s))
    rows = spark.createDataFrame([(x, i) for i, x in enumerate(labels)], "stage string, n int").repartition(3)
    got = lb.propose_labels(rows, "stage", lb.canonical_labels(spark, canonical), most, q).collect()
    assert sorted((r.label, r.rows, r.proposal, r.distance, r.nearest) for r in got) == _brute(labels, canonical, most)


def test_rows_get_their_proposal_and_keep_the_rest(spark):
    rows = spark.createDataFrame([("Firmaa", 1), ("Otro", 2), (None, 3), ("Firma", 4), ("FIRMA", 5)], "stage string, n int")
    found = lb.propose_labels(rows, "stage", lb.canonical_labels(spark, [s.label for s in STAGES]))
    out = lb.with_proposals(rows, "stage", found)
    assert out.columns == ["stage", "n"]
    assert {r.n: r.stage for r in out.collect()} == {1: "Firma", 2: "Otro", 3: None, 4: "Firma", 5: "Firma"}
    assert lb.propose_labels(rows.limit(0), "stage", lb.canonical_labels(spark, ["a"])).collect() == []
