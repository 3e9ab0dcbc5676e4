"""Personal data by weak supervision (DataFrame functions only on the texts).

Candidate spans come from regular expressions: the base patterns (e-mail, IP address, card
and phone number, as fixed below) and looser ones (spelled-out e-mail addresses, national
phone numbers, 15-digit cards, IPv6). Labelers vote on every candidate: its strict pattern,
gazetteers (top-level domains, issuer prefixes, special-use networks, area codes), the words
before it, and the words that speak against it. Expectation-maximisation estimates how far
each labeler can be trusted per kind; its posteriors then train the final span classifier
(log odds of span features). Base spans always stay; a looser candidate that overlaps none is
added when the classifier gives it at least ``THRESHOLD``.

The texts are read once; candidates are a column of arrays beside doc_id, so nothing is
joined or grouped by document. Only vote patterns (at most 3 to the number of labelers, per
kind) and feature values (fixed buckets) reach the driver, as counts over all candidates.

Offsets are code points, from 0, end exclusive. Defined cases: a null or empty text has no
span; repeated rows each give a row; a text of very many matches takes time in proportion to
them (but for the sort of overlaps); without candidates the classifier adds nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from erpweave.llm.stored import stored

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9
ROUNDS = 30
PIECE = 256
#: Characters before a span that the labelers see.
AROUND = 40

# The base patterns. Starts within a run that cannot differ from the run's start
# are skipped by the look-behind; \G lets a match begin where the last one ended.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried on it.
BASE_HINT = {"email": "@", "phone": "+"}

LOOSE = {
    "email": (
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64} ?(?:\[at\]|\(at\)|\{at\}) ?[a-z0-9-]{2,63}"
        r"(?: ?(?:\[dot\]|\(dot\)|\{dot\}|\.) ?[a-z0-9-]{2,63}){1,4}(?![a-z0-9-])"
    ),
    "ip": r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])",
    "card": r"(?<![0-9.+-])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9-])",
}
LOOSE_HINT = {"email": r"(?i)[\[({]at[\])}]", "ip": ":", "card": r"3[47][0-9]{2}", "phone": r"[0-9]{3}[ .-][0-9]{4}"}

# Gazetteers.
TOP_LEVEL = (
    "com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "us", "ca", "nl", "ch", "at", "be", "eu", "pl", "se",
    "no", "dk", "fi", "pt", "ie", "cz", "ru", "jp", "cn", "in", "br", "mx", "ar", "au", "nz", "co", "biz", "me", "dev", "app",
)
SPECIAL_NET = r"^(?:0|10|127|169\.254|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|62)"
CUES = {
    "email": r"mail|contact|write to|reach|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|client|from|adresse",
    "card": r"card|visa|master|amex|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|tel\b|tel[.:]|call|mobile|fax|cell|contact|telefon|tél",
}
AGAINST = r"version|\bv$|isbn|issn|\bno\.?\s*$|order|invoice|page|chapter|serial|part|release|build|\$\s*$|€\s*$"


def _empty() -> Column:
    return F.expr("cast(array() as array<struct<s: int, e: int, m: string, before: string, after: string>>)")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """The fold of all earlier elements at every element of an array, ``merge`` being associative.

    A fold that appends copies its list at every step, so it runs over pieces of ``PIECE``
    elements, then over the pieces' totals: n elements copy n * PIECE / 2 + (n / PIECE)^2 / 2
    cells, which is in proportion to n up to about PIECE^3, some 16 million matches in one text.
    """

    def small(xs: Column) -> Column:
        start = F.struct(zero.alias("at"), F.filter(F.array(zero), lambda x: F.lit(False)).alias("out"))
        return F.aggregate(
            xs, start, lambda acc, x: F.struct(merge(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"]
        )

    def joined(pieces: Column) -> Column:
        before = small(F.transform(pieces, lambda p: F.aggregate(p, zero, merge)))
        return F.flatten(F.transform(
            F.arrays_zip(pieces.alias("p"), before.alias("b")), lambda x: F.transform(small(x["p"]), lambda v: merge(x["b"], v))
        ))

    def by_pieces(xs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(xs) - 1, F.lit(0)) / PIECE).cast("int"))
        return _let(F.transform(starts, lambda i: F.slice(xs, i * PIECE + 1, PIECE)), joined)

    return _let(values, by_pieces)


def spans(text: Column, pattern: str) -> Column:
    """Start, end and text of the leftmost non-overlapping matches, in code points, with the
    ``AROUND`` characters before and the one after each.

    The matches and the pieces between them alternate, so their running lengths give the places
    and their running ends the characters before, in time in proportion to the text.
    """
    cut = F.struct(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))

    def paired(c: Column) -> Column:
        n = F.size(c["g"])
        return F.slice(
            F.arrays_zip(c["g"].alias("g"), c["m"].alias("m"), F.slice(c["g"], 2, n).alias("g2"), F.slice(c["m"], 2, n).alias("m2")),
            1, F.size(c["m"]),
        )

    def placed(xs: Column) -> Column:
        end = F.lit(AROUND)
        steps = F.transform(xs, lambda x: F.struct(
            (F.length(x["g"]) + F.length(x["m"])).alias("n"), F.right(F.concat(x["g"], F.right(x["m"], end)), end).alias("end")
        ))
        so_far = running(
            steps,
            F.struct(F.lit(0).alias("n"), F.lit("").alias("end")),
            lambda a, b: F.struct((a["n"] + b["n"]).alias("n"), F.right(F.concat(a["end"], b["end"]), end).alias("end")),
        )

        def cell(z: Column) -> Column:
            x, start = z["x"], z["a"]["n"] + F.length(z["x"]["g"])
            return F.struct(
                start.alias("s"), (start + F.length(x["m"])).alias("e"), x["m"].alias("m"),
                F.right(F.concat(z["a"]["end"], F.right(x["g"], end)), end).alias("before"),
                F.left(F.concat(F.left(x["g2"], F.lit(1)), F.coalesce(F.left(x["m2"], F.lit(1)), F.lit(""))), F.lit(1)).alias("after"),
            )

        return F.transform(F.arrays_zip(xs.alias("x"), so_far.alias("a")), cell)

    return _let(_let(cut, paired), placed)


def apart(found: Column, others: Column) -> Column:
    """The spans of ``found`` that overlap none of ``others``, by one sort of both.

    In order of their starts, a span is apart from the earlier ones if the largest of their
    ends does not pass its start, and from the later ones if the next start does not lie
    before its end.
    """
    far = F.lit(2**31 - 1)
    mine = F.transform(found, lambda x: F.struct(x["s"].alias("at"), F.lit(1).alias("own"), x.alias("x")))
    theirs = F.transform(others, lambda y: F.struct(y["s"].alias("at"), F.lit(0).alias("own"), y.alias("x")))

    def pick(xs: Column) -> Column:
        before = running(F.transform(xs, lambda x: F.when(x["own"] == 0, x["x"]["e"]).otherwise(-1)), F.lit(-1), lambda a, b: F.greatest(a, b))
        after = F.reverse(running(F.transform(F.reverse(xs), lambda x: F.when(x["own"] == 0, x["at"]).otherwise(far)), far, lambda a, b: F.least(a, b)))
        kept = F.filter(
            F.arrays_zip(xs.alias("x"), before.alias("b"), after.alias("a")),
            lambda z: (z["x"]["own"] == 1) & (z["b"] <= z["x"]["at"]) & (z["a"] >= z["x"]["x"]["e"]),
        )
        return F.transform(kept, lambda z: z["x"]["x"])

    return F.when((F.size(found) == 0) | (F.size(others) == 0), found).otherwise(_let(F.array_sort(F.concat(mine, theirs)), pick))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Whether the digits of ``m`` pass the Luhn check."""
    d = F.reverse(_digits(m))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(d)),
        F.lit(0),
        lambda acc, i: acc
        + F.when(i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
            F.substring(d, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(d, i, F.lit(1)) >= "5", 9).otherwise(0)
        ),
    )
    return total % 10 == 0


def _octets(m: Column) -> Column:
    plain = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(plain, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _passes(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {
        "email": F.lit(True),
        "ip": _octets(m),
        # The length first: Luhn is only worked out for numbers of card length.
        "card": F.when(n.between(16, 19), _luhn(m)).otherwise(F.lit(False)),
        "phone": n.between(8, 15),
    }[kind]


def base_spans(text: Column, kind: str, has_digit: Column) -> Column:
    """The spans of a base pattern that pass its check."""
    hint = F.contains(text, F.lit(BASE_HINT[kind])) if kind in BASE_HINT else has_digit
    found = F.filter(spans(text, BASE[kind]), lambda x: _passes(kind, x["m"]))
    return F.when(hint, found).otherwise(_empty())


def _loose_spans(text: Column, kind: str) -> Column:
    found = spans(text, LOOSE[kind])
    if kind == "card":
        found = F.filter(found, lambda x: _luhn(x["m"]))
    return F.when(text.rlike(LOOSE_HINT[kind]), found).otherwise(_empty())


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, 0 or - (abstains)."""
    return F.when(yes, F.lit("1")).when(no if no is not None else F.lit(True), F.lit("0")).otherwise(F.lit("-"))


def _votes(kind: str, x: Column, base: bool) -> Column:
    """One character per labeler: strict pattern, gazetteer, words before, words against, form."""
    m = x["m"]
    before, after = F.lower(x["before"]), x["after"]
    gazetteer = {
        "email": F.lower(F.regexp_extract(m, r"([A-Za-z]+)[^A-Za-z]*$", 1)).isin(*TOP_LEVEL),
        "ip": ~m.rlike(SPECIAL_NET),
        "card": _digits(m).rlike(ISSUER),
        "phone": ~F.substring(_digits(m), -7, 3).isin("000", "111", "123"),
    }[kind]
    cue, against = before.rlike(CUES[kind]), before.rlike(AGAINST)
    form = {
        "email": m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{1,40}[^A-Za-z0-9]") & ~m.contains(".."),
        "ip": ~m.rlike(r"(^|\.)0[0-9]"),
        "card": m.rlike(r"^[0-9]{15,16}$|^[0-9]{4}([ -][0-9]{4}){3}$"),
        "phone": m.rlike(r"[ ().-]"),
    }[kind]
    return F.concat(
        F.lit("1" if base else "-"),
        _vote(gazetteer),
        _vote(cue, F.lit(False)),
        F.when(against, F.lit("0")).otherwise(F.lit("-")),
        _vote(form & ~after.rlike("[A-Za-z0-9]")),
    )


def _features(kind: str, x: Column, votes: Column) -> Column:
    """Bucketed features of a span for the final classifier."""
    m = x["m"]
    return F.array(
        F.concat(F.lit("length:"), F.least(F.length(m), F.lit(40)).cast("string")),
        F.concat(F.lit("digits:"), F.least(F.length(_digits(m)), F.lit(24)).cast("string")),
        F.concat(F.lit("marks:"), F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace(m, "[A-Za-z0-9]", ""), ""))), "")),
        F.concat(F.lit("around:"), F.substring(votes, 2, 4)),
    )


def _described(found: Column, kind: str, base: bool) -> Column:
    """The spans with their kind, votes and features."""

    def cell(x: Column) -> Column:
        votes = _votes(kind, x, base)
        return F.struct(
            F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.lit(base).alias("base"),
            votes.alias("votes"), _features(kind, x, votes).alias("features"),
        )

    return F.transform(found, cell)


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id and cands (kind, s, e, base, votes, features), base spans and looser ones that overlap none of them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("t")).withColumn("digit", F.col("t").rlike("[0-9]"))
    df = df.select(
        "doc_id",
        "t",
        *[base_spans(F.col("t"), k, F.col("digit")).alias(f"base_{k}") for k in KINDS],
        *[_loose_spans(F.col("t"), k).alias(f"loose_{k}") for k in KINDS],
    )
    own = F.concat(*[F.col(f"base_{k}") for k in KINDS])
    parts = []
    for kind in KINDS:
        for base in (True, False):
            found = F.col(f"{'base' if base else 'loose'}_{kind}")
            if not base:
                found = apart(found, own)
            parts.append(_described(found, kind, base))
    return df.select("doc_id", F.concat(*parts).alias("cands"))


def estimate(patterns: list[tuple[str, str, int]], rounds: int = ROUNDS) -> dict[tuple[str, str], float]:
    """Posterior per (kind, vote pattern) from (kind, pattern, count), by expectation-maximisation.

    Two latent classes per kind; every labeler has a rate of voting 1 in either class. It
    starts from the share of 1 among a pattern's votes.
    """
    out: dict[tuple[str, str], float] = {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = [(p, n) for k, p, n in patterns if k == kind]
        width = len(rows[0][0])
        post = {p: (1 + p.count("1")) / (2 + p.count("1") + p.count("0")) for p, _ in rows}
        for _ in range(rounds):
            mass = [sum(n * (1 - post[p]) for p, n in rows) + 1, sum(n * post[p] for p, n in rows) + 1]
            rate = [[0.5] * width, [0.5] * width]
            for j in range(width):
                for c in (0, 1):
                    w = [(n * (post[p] if c else 1 - post[p]), p[j]) for p, n in rows if p[j] != "-"]
                    # A labeler starts as better than chance: 1 of 5 pseudo votes is wrong.
                    rate[c][j] = (sum(x for x, v in w if v == "1") + (4 if c else 1)) / (sum(x for x, _ in w) + 5)
            for p, _ in rows:
                log = [math.log(m / sum(mass)) for m in mass]
                for j, v in enumerate(p):
                    if v != "-":
                        for c in (0, 1):
                            log[c] += math.log(rate[c][j] if v == "1" else 1 - rate[c][j])
                post[p] = 1 / (1 + math.exp(max(-700.0, min(700.0, log[0] - log[1]))))
        out |= {(kind, p): post[p] for p, _ in rows}
    return out


def _map(pairs: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for k, v in sorted(pairs.items()) for x in (k, float(v))])


def train(cands: DataFrame) -> dict[str, float]:
    """Weights of the final classifier: ``kind`` is its intercept, ``kind|feature`` a feature's log odds."""
    one = cands.select(F.explode("cands").alias("c")).select("c.*")
    patterns = [(r.kind, r.votes, r.n) for r in one.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()]
    if not patterns:
        return {}
    post = estimate(patterns)
    p = F.element_at(_map({f"{k}|{v}": x for (k, v), x in post.items()}), F.concat_ws("|", "kind", "votes"))
    weighted = one.select("kind", F.explode("features").alias("f"), p.alias("p"))
    rows = weighted.groupBy("kind", "f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    weights: dict[str, float] = {}
    for kind in KINDS:
        yes = sum(n * post[k, v] for k, v, n in patterns if k == kind)
        no = sum(n * (1 - post[k, v]) for k, v, n in patterns if k == kind)
        weights[kind] = math.log((yes + 1) / (no + 1))
        for r in rows:
            if r.kind == kind:
                weights[f"{kind}|{r.f}"] = math.log((r.yes + 1) / (yes + 2)) - math.log((r.no + 1) / (no + 2))
    return weights


def _as_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, base and found (arrays of kind, s, e, by kind as listed, then start) per document."""
    cands = stored(docs.sparkSession, find_candidates(docs), "pii-candidates")
    weights = train(cands)
    if weights:
        known = _map(weights)

        def score(c: Column) -> Column:
            terms = F.transform(c["features"], lambda f: F.coalesce(F.element_at(known, F.concat_ws("|", c["kind"], f)), F.lit(0.0)))
            return F.element_at(known, c["kind"]) + F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

        taken = F.filter("cands", lambda c: c["base"] | (score(c) >= math.log(THRESHOLD / (1 - THRESHOLD))))
    else:
        taken = F.col("cands")
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    placed = F.array_sort(
        F.transform(taken, lambda c: F.struct(F.element_at(rank, c["kind"]).alias("r"), c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"), c["base"].alias("base")))
    )
    return cands.select("doc_id", placed.alias("found")).select(
        "doc_id", F.filter("found", lambda c: c["base"]).alias("base"), "found"
    )


def _of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda c: c["kind"] == kind))


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, base_sha256 and spans per document."""
    counts = [_of_kind(F.col("base"), k).cast("long").alias(f"n_{k}") for k in KINDS]
    return detect(docs).select("doc_id", *counts, F.sha2(_as_text(F.col("base")), 256).alias("base_sha256"), _as_text(F.col("found")).alias("spans"))
