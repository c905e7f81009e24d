"""Personal data by weak supervision, in Spark's own functions (op 10).

Four kinds of spans: email, ip, card, phone. Strict patterns give the base spans,
which always stay; looser patterns give further candidates. A regex, a gazetteer
and a context labeler vote on every candidate. Expectation-maximisation over the
counts of vote patterns estimates how reliable each labeler is on each kind; the
resulting posteriors train a logistic span classifier, which decides about the
candidates that aren't base spans.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive quantifiers and the look-behind
#: change no match; they keep the matcher from trying every tail of a long run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser patterns; what they find beside the base spans is decided by the classifier.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]{1,63}){1,4}",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: Gazetteers (domain endings, card issuers' first digits, calling codes).
TLDS = "com|org|net|edu|gov|info|io|co|de|fr|es|it|uk|eu|ch|at|be|nl"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|64[4-9]|62|35)"
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach|schreib|kontakt|courriel|correo|escrib)",
    "ip": r"(?i)(?:\bip\b|host|server|address|login|from|von|depuis|desde)",
    "card": r"(?i)(?:card|visa|master|credit|debit|payment|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax|cell|ruf|appel|llam)",
}
CONTEXT = 24  # characters before a span that the context labeler sees
ROUNDS, STEPS = 50, 400
_SPANS = "array<struct<start:int,end:int,s:string>>"


def find_spans(gaps: Column, matches: Column, keep) -> Column:
    """``array<struct<start, end, s>>`` of those ``matches`` (strings, in order)
    that ``keep`` holds for; ``gaps`` are the texts between them, so the lengths
    add up to offsets, in code points. Both are columns of the row, not formulas:
    a formula would be computed again for each match."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def add(acc: Column, i: Column) -> Column:
        start, s = acc["at"] + F.length(F.get(gaps, i)), F.get(matches, i)
        end = start + F.length(s)
        one = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), s.alias("s"))
        return F.struct(end.alias("at"), F.when(keep(s), F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), zero, add, lambda acc: acc["out"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _octets_ok(s: Column) -> Column:
    part = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(p.try_cast("decimal(38,0)"), F.lit(999)) <= 255)
    return F.forall(F.split(s, r"\."), part)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    d = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")  # noqa: E731  the i-th from the right

    def add(acc: Column, i: Column) -> Column:
        twice = d(i) * 2
        return acc + F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d(i))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return _octets_ok(s)
    n = F.length(_digits(s))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(s))).otherwise(F.lit(False))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _gazetteer(kind: str, s: Column) -> Column:
    """+1 or -1: the span's ending, first digits or calling code is a known one or not."""
    known = {
        "email": F.lower(s).rlike(rf"(?:\.|dot ?[\])] ?)(?:{TLDS})$"),
        "ip": ~s.rlike(r"^(?:0|127|255)\."),
        "card": _digits(s).rlike(ISSUERS),
        "phone": s.rlike(CALLING) | s.rlike(r"^\(?[2-9]"),
    }[kind]
    return F.when(known, 1).otherwise(-1)


def _voted(kind: str, strict: bool):
    """The candidate struct of a found span, with its votes and features."""

    def one(x: Column) -> Column:
        s = x["s"]
        before = F.substring(F.col("t"), F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT)))
        valid = _valid(kind, s) if strict else F.lit(False)
        return F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), valid.alias("base"),
            (F.when(valid, 1).otherwise(-1) if strict else F.lit(0)).alias("regex"),
            _gazetteer(kind, s).alias("gazetteer"), F.when(before.rlike(CUES[kind]), 1).otherwise(0).alias("context"),
            F.least(F.floor(F.length(s) / 8), F.lit(4)).cast("int").alias("size"),
            s.rlike("[ ().-]").cast("int").alias("marks"))

    return one


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)``: every document row with the candidates of its whole
    text, ``{kind, start, end, base, regex, gazetteer, context, size, marks}``.

    ``base``: a valid match of the kind's base pattern. The regex labeler votes 1
    for a valid base match, -1 for one that fails (a card-like number of 16 to
    19 digits without its check digit) and 0 for a loose one; the context labeler
    votes 1 if a cue stands shortly before, else 0. ``size`` and ``marks`` are
    the classifier's other inputs: length in steps of 8 characters up to 4, and
    whether the span has separators."""
    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("t"))
    hint = {"email": F.contains("t", F.lit("@")), "phone": F.contains("t", F.lit("+")), "ip": F.contains("t", F.lit("."))}
    none = F.array().cast("array<string>")
    names = [(k, "base", PATTERNS[k]) for k in KINDS] + [(k, "loose", p) for k, p in LOOSE.items()]
    for k, how, p in names:
        found = F.regexp_extract_all("t", F.lit(p), F.lit(0))
        guard = {"base": hint.get(k), "loose": F.contains("t", F.lit("at")) if k == "email" else F.col("t").rlike("[0-9]{4}")}[how]
        d = d.withColumn(f"m_{how}_{k}", found if guard is None else F.when(guard, found).otherwise(none))
    for k, how, p in names:
        m = F.col(f"m_{how}_{k}")
        # only a match of 16 characters can be a card, so other texts needn't be split
        some = F.exists(m, lambda s: F.length(s) >= 16) if k == "card" else F.size(m) > 0
        d = d.withColumn(f"g_{how}_{k}", F.when(some, F.split("t", p, -1)))
    for k, how, p in names:
        keep = (lambda s: F.length(_digits(s)).between(16, 19)) if k == "card" else (lambda s: F.lit(True))
        g = F.col(f"g_{how}_{k}")
        spans = F.when(g.isNotNull(), find_spans(g, F.col(f"m_{how}_{k}"), keep)).otherwise(F.array().cast(_SPANS))
        d = d.withColumn(f"p_{how}_{k}", spans)
    parts = []
    for k, how, _ in names:
        parts.append(F.transform(F.col(f"p_{how}_{k}"), _voted(k, how == "base")))
    return d.select("doc_id", F.concat(*parts).alias("spans"))


def vote_counts(found: DataFrame) -> list[dict]:
    """How many candidates show each combination of kind, votes and features: at
    most 4 x 3 x 2 x 2 x 5 x 2 x 2 rows, whatever the number of documents."""
    s = found.select(F.explode("spans").alias("s")).select("s.kind", "s.regex", "s.gazetteer", "s.context", "s.size", "s.marks", "s.base")
    return [r.asDict() for r in s.groupBy(*s.columns).count().collect()]


def label_model(counts: list[dict]) -> dict[tuple, float]:
    """Posterior probability of personal data for each kind and vote pattern.

    Expectation-maximisation of a two-class model in which labelers vote
    independently given the class: each has, per kind, a chance of each vote in
    each class. It starts from labelers that are right more often than not, and
    every estimate is smoothed, so one kind without candidates does no harm."""
    labelers = ("regex", "gazetteer", "context")
    posterior: dict[tuple, float] = {}
    for kind in KINDS:
        rows: dict[tuple, int] = defaultdict(int)
        for r in counts:
            if r["kind"] == kind:
                rows[tuple(r[name] for name in labelers)] += r["count"]
        prior = 0.5
        chance = [{c: {v: (0.6 if v * (2 * c - 1) > 0 else 0.25 if v == 0 else 0.15) for v in (-1, 0, 1)} for c in (0, 1)} for _ in labelers]
        for _ in range(ROUNDS):
            post = {}
            for votes in rows:
                yes = prior * math.prod(chance[j][1][v] for j, v in enumerate(votes))
                no = (1 - prior) * math.prod(chance[j][0][v] for j, v in enumerate(votes))
                post[votes] = yes / (yes + no)
            total = sum(rows.values())
            prior = (1 + sum(n * post[v] for v, n in rows.items())) / (2 + total)
            for j in range(len(labelers)):
                for c in (0, 1):
                    weight = {v: 1.0 for v in (-1, 0, 1)}
                    for votes, n in rows.items():
                        weight[votes[j]] += n * (post[votes] if c else 1 - post[votes])
                    chance[j][c] = {v: w / sum(weight.values()) for v, w in weight.items()}
        posterior |= {(kind, *v): p for v, p in post.items()} if rows else {}
    return posterior


def features(r: dict) -> dict[str, float]:
    return {f"kind={r['kind']}": 1.0, f"{r['kind']}:regex={r['regex']}": 1.0, f"{r['kind']}:gazetteer": r["gazetteer"],
            f"{r['kind']}:context": r["context"], f"{r['kind']}:size={r['size']}": 1.0, f"{r['kind']}:marks": r["marks"]}


def fit_classifier(counts: list[dict]) -> dict[str, float]:
    """Logistic weights of the span features, fitted to the label model's posteriors
    by gradient steps over the counted combinations, each weighted by its share."""
    posterior = label_model(counts)
    total = sum(r["count"] for r in counts) or 1
    rows = [(features(r), posterior[r["kind"], r["regex"], r["gazetteer"], r["context"]], r["count"] / total) for r in counts]
    weights: dict[str, float] = {name: 0.0 for f, _, _ in rows for name in f}
    for _ in range(STEPS):
        slope = {name: 0.001 * w for name, w in weights.items()}
        for f, y, share in rows:
            p = 1 / (1 + math.exp(-sum(weights[n] * v for n, v in f.items())))
            for n, v in f.items():
                slope[n] += share * (p - y) * v
        weights = {n: w - 2.0 * slope[n] for n, w in weights.items()}
    return weights


def _score(x: Column, weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for name, w in sorted(weights.items()):
        kind, _, rest = name.partition(":")
        if name.startswith("kind="):
            term = x["kind"] == name[5:]
        elif "=" in rest:
            term = (x["kind"] == kind) & (x[rest.split("=")[0]] == int(rest.split("=")[1]))
        else:
            total = total + F.when(x["kind"] == kind, x[rest] * F.lit(w)).otherwise(0.0)
            continue
        total = total + F.when(term, F.lit(w)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``(doc_id, spans)`` per document row: ``{kind, start, end, base, score}``,
    ordered by kind as in KINDS, then by start.

    All base spans, and those candidates that the classifier scores over
    ``least`` and that overlap no base span of their kind. NULL and empty texts
    have none; repeated rows each have theirs. Candidates are written once, so
    the patterns run once over the texts."""
    found = materialize(candidates(docs, doc_id, text), "candidates")
    weights = fit_classifier(vote_counts(found))
    scored = F.transform("spans", lambda x: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("nr"), x["start"].alias("start"), x["end"].alias("end"),
        x["kind"].alias("kind"), x["base"].alias("base"), _score(x, weights).alias("score")))
    d = found.select("doc_id", scored.alias("all"))
    base = F.filter("all", lambda x: x["base"])
    clear = lambda x: ~F.exists("base", lambda b: (b["kind"] == x["kind"]) & (b["start"] < x["end"]) & (x["start"] < b["end"]))
    added = F.filter("all", lambda x: ~x["base"] & (x["score"] > least) & clear(x))
    return d.withColumn("base", base).select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, SHA-256 of their list, and the list of all spans."""
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["base"])
    count = lambda k: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == k))).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
