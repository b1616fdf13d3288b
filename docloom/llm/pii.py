"""Personal data by weak supervision, in Spark's own functions: patterns, gazetteers and contexts vote on candidates, expectation-maximisation learns how far each is
to be trusted, and a span classifier is trained on what they agree on."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
# Each pattern finds its base form and, after the bar, further forms that only the votes can confirm. A repetition that can't give anything back is possessive, and a run
# is tried from its beginning only, or where the match before ended: the matches are the same, and no text takes more than a few steps a character.
_NAME, _HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
_AT, _DOT = r"\x20?(?:\(at\)|\[at\]|\{at\})\x20?", r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\.)"
PATTERNS = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@{_HOST}++(?:\.{_HOST}++)++|(?<!{_NAME}){_NAME}++{_AT}{_HOST}++(?:{_DOT}{_HOST}++)++(?!{_NAME}*+@)",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]|(?<![0-9A-Za-z+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z+-])",
}
# What the gazetteers and contexts go by.
TOPS = ["com", "org", "net", "edu", "gov", "info", "biz", "io", "eu", "de", "fr", "es", "it", "nl", "uk", "us", "ch", "at", "be", "ca", "au", "jp", "in", "br", "mx"]
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|36|38|6011|65|35)"
CODES = r"^\+(?:1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
SPECIAL = r"^(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CUES = {
    "email": r"(?i)mail|contact|courriel|correo|write to|reach",
    "ip": r"(?i)\bip\b|address|adresse|direcci|server|host|serveur|servidor|login|from",
    "card": r"(?i)card|karte|carte|tarjeta|visa|credit|payment|account|konto",
    "phone": r"(?i)phone|\btel|call|mobile|\bfax|ruf|appel|llam|contact",
}
AGAINST = r"(?i)version|\bv\.?\s*$|isbn|order|invoice|serial|sha|hash|token|commit|build|chapter|section"
#: Code points before a candidate that are its context.
CONTEXT = 30
#: Lengths that one step of a running sum goes over.
BLOCK = 128
#: How much more a labeler's vote counts for what it says before anything is learned.
PRIOR = 10.0
LABELERS = ("form", "check", "gazetteer", "context", "edges")


def running(lengths: Column) -> Column:
    """The sum of what comes before each element: in blocks, so that long lists take few copies."""
    add = lambda a, x: F.array_append(a, F.element_at(a, -1) + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    sums = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda a, x: add(a, F.aggregate(x, F.lit(0).cast("long"), lambda s, y: s + y)))
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), F.slice(sums, F.lit(1), F.size(sums) - 1).alias("s")), lambda z: F.slice(F.aggregate(z["b"], F.array(z["s"]), add), F.lit(1), F.size(z["b"]))))


def luhn(digits: Column) -> Column:
    """Whether the checksum of a number of 13 to 19 digits is right; of no other number."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        x = F.substr(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, x).when(x > 4, x * 2 - 9).otherwise(x * 2)

    fits = F.length(digits).between(13, 19)
    return F.coalesce(fits & (F.aggregate(F.transform(F.sequence(F.lit(1), F.when(fits, F.length(digits)).otherwise(F.lit(1))), worth), F.lit(0), lambda s, x: s + x) % 10 == 0), F.lit(False))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _base(kind: str, m: Column, digits: Column) -> tuple[Column, Column]:
    """Whether a match has the base form, and whether what the form can't say is right: parts, checksum, number of digits."""
    if kind == "email":
        return m.contains("@"), m.rlike(r"\.[A-Za-z]{2,}$") | m.contains("@")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return F.lit(True), m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.lit(True), luhn(digits)
    return m.startswith("+"), F.length(digits).between(9, 15)


def _gazetteer(kind: str, m: Column, digits: Column) -> Column:
    if kind == "email":
        return _vote(F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1)).isin(TOPS), m.rlike(r"[0-9]$"))
    if kind == "ip":
        return _vote(~m.rlike(SPECIAL), m.rlike(SPECIAL))
    if kind == "card":
        return _vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS))
    return _vote(m.rlike(CODES), m.startswith("+"))


def _class(c: Column) -> Column:
    return F.when(c == "", "end").when(c.rlike(r"[\p{L}\p{N}]"), "word").when(c.rlike(r"\s"), "blank").otherwise("mark")


def _candidate(kind: str, m: Column, start: Column, before: Column, after: Column) -> Column:
    """kind, start, end, base, the labelers' votes (1: personal, -1: not, 0: abstains) and the classifier's features of one match."""
    digits = F.regexp_replace(m, r"[^0-9]", "")
    form, check = _base(kind, m, digits)
    left, right = _class(F.right(before, F.lit(1))), _class(after)
    votes = F.array(
        _vote(form & check, ~form & ~check), _vote(check, ~check), _gazetteer(kind, m, digits),
        _vote(before.rlike(CUES[kind]), before.rlike(AGAINST)), _vote((left != "word") & (right != "word"), (left == "word") | (right == "word")),
    )
    size = F.when(F.length(m) < 12, "short").when(F.length(m) < 20, "middle").otherwise("long")
    marks = F.when(m.rlike(r"[()\[\]{}]"), "brackets").when(m.contains(" "), "blanks").when(m.contains("-"), "dashes").otherwise("plain")
    features = F.array(F.concat(F.lit("left="), left), F.concat(F.lit("right="), right), F.concat(F.lit("size="), size), F.concat(F.lit("marks="), marks), F.concat(F.lit("context="), F.get(votes, F.lit(3)).cast("string")), F.when(check, "check=right").otherwise("check=wrong"))
    return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), (form & check).alias("base"), votes.alias("votes"), features.alias("features"))


def _steps(gaps: str, matches: str) -> Column:
    """How far the start of each match, but for its own length, lies after the one before: that match and the gap between."""
    return F.transform(gaps, lambda g, i: F.length(g) + F.when(i > 0, F.length(F.get(F.col(matches), i - 1))).otherwise(0))


def _starts(steps: str) -> Column:
    return F.transform(running(F.col(steps)), lambda s, i: s + F.get(F.col(steps), i))


def _matches(matches: str, starts: str, gaps: str) -> Column:
    """Each match m with its start s, the code points before it b, and the one after a."""
    return F.transform(matches, lambda m, i: F.struct(m.alias("m"), F.get(F.col(starts), i).alias("s"), F.right(F.get(F.col(gaps), i), F.lit(CONTEXT)).alias("b"), F.left(F.get(F.col(gaps), i + 1), F.lit(1)).alias("a")))


def _judged(matches: str, kind: str) -> Column:
    return F.transform(matches, lambda x: _candidate(kind, x["m"], x["s"], x["b"], x["a"]))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and found, the candidates of all kinds in the order of kinds and places: every base match, right or not, and the further forms. Numbers that have no card's length are none."""
    d = common.fit_columns(docs, {"doc_id": "long", "text": "string"}).withColumn("text", F.coalesce("text", F.lit("")))
    # a kind's pattern only runs where its mark is in the text
    marked = {"email": F.col("text").contains("@") | F.col("text").contains("at)") | F.col("text").contains("at]") | F.col("text").contains("at}")}
    for k in KINDS:
        here = F.when(marked.get(k, F.col("text").rlike("[0-9][^A-Za-z]*[0-9]")), F.col("text")).otherwise("")
        d = d.withColumn(f"m_{k}", F.regexp_extract_all(here, F.lit(PATTERNS[k]), F.lit(0))).withColumn(f"g_{k}", F.when(F.size(f"m_{k}") > 0, F.split(here, PATTERNS[k], -1)).otherwise(F.array(F.lit(""))))
    d = d.drop("text")
    for k in KINDS:
        d = d.withColumn(f"l_{k}", _steps(f"g_{k}", f"m_{k}"))
    for k in KINDS:
        d = d.withColumn(f"s_{k}", _starts(f"l_{k}"))
    for k in KINDS:
        each = _matches(f"m_{k}", f"s_{k}", f"g_{k}")
        d = d.withColumn(f"c_{k}", F.filter(each, lambda x: F.length(F.regexp_replace(x["m"], "[^0-9]", "")).between(13, 19)) if k == "card" else each)
    return d.select("doc_id", F.concat(*[_judged(f"c_{k}", k) for k in KINDS]).alias("found"))


def reliabilities(patterns: DataFrame, rounds: int = 12) -> dict[str, float]:
    """Log odds that a candidate is personal, and what each vote of each labeler adds, by expectation-maximisation over the patterns of votes: (kind, votes, features, n),
    as many as there are kinds, votes and features together, whatever the input. Kinds share the labelers' reliabilities, of which a labeler starts with PRIOR
    times more for than against what it votes: without that, where nearly all candidates are good, rare forms would be a class of their own. Only sums per vote come to the driver."""
    each = common.written(patterns.groupBy("votes").agg(F.sum("n").alias("n")))
    total = F.aggregate("votes", F.lit(0), lambda s, v: s + v)
    odds = F.when(total > 0, 2.0).when(total < 0, -2.0).otherwise(0.0)
    prior = {f"{i}/{v}": (PRIOR**max(v, 0), PRIOR ** max(-v, 0)) for i in range(len(LABELERS)) for v in (-1, 0, 1)}
    weights: dict[str, float] = {}
    for _ in range(rounds):
        weights = _weights(_sums(each, odds, _vote_names()), prior)
        odds = _odds(weights, _vote_names())
    return weights


def _vote_names() -> Column:
    return F.transform("votes", lambda v, i: F.concat_ws("/", i.cast("string"), v.cast("string")))


def _sums(patterns: DataFrame, odds: Column, names: Column) -> dict[str, tuple[float, float]]:
    """How many are personal, and how many not, of those with each name; of all for ``."""
    p = 1 / (1 + F.exp(-odds))
    each = patterns.select(F.explode(F.concat(F.array(F.lit("")), names)).alias("name"), (F.col("n") * p).alias("yes"), (F.col("n") * (1 - p)).alias("no"))
    return {r["name"]: (r["yes"], r["no"]) for r in each.groupBy("name").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()}


def _weights(sums: dict[str, tuple[float, float]], prior: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Log odds of all, for ``, and what each name adds, given counts for and against it that come on top."""
    yes, no = sums.get("", (0.0, 0.0))
    more = [sum(x[i] for x in prior.values()) for i in (0, 1)]
    out = {"": math.log((yes + 1) / (no + 1))}
    for name in {*sums, *prior} - {""}:
        y, n = sums.get(name, (0.0, 0.0))
        a, b = prior.get(name, (1.0, 1.0))
        out[name] = math.log((y + a) / (yes + more[0] + 1)) - math.log((n + b) / (no + more[1] + 1))
    return out


def _odds(weights: dict[str, float], names: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
    return F.lit(weights[""]) + F.aggregate(names, F.lit(0.0), lambda s, x: s + F.coalesce(F.try_element_at(table, x), F.lit(0.0)))


def classifier(patterns: DataFrame, votes: dict[str, float]) -> dict[str, float]:
    """The span classifier's weights: naive Bayes over features, each candidate counted as personal as far as the votes make it so."""
    return _weights(_sums(patterns, _odds(votes, _vote_names()), F.col("features")), {})


def personal(docs: DataFrame, sure: float = 0.9) -> DataFrame:
    """doc_id, base and spans per row: arrays of (kind, start, end), in code points, end exclusive, by kind and place. base: what the patterns find and the checks pass;
    spans: those and the candidates that pass the checks and of which the classifier is sure. No two spans of a kind overlap.

    A null or empty text has none; repeated rows are found each; a null doc_id stays null; an empty table gives an empty result; further columns are left out."""
    found = common.written(candidates(docs))
    patterns = common.written(found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count("*").alias("n")))
    weights = classifier(patterns, reliabilities(patterns))
    span = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    # a wrong checksum, part or number of digits rules a span out, whatever the classifier says
    ok = lambda c: c["base"] | F.array_contains(c["features"], "check=right") & (1 / (1 + F.exp(-_odds(weights, c["features"]))) >= sure)
    return found.select("doc_id", F.transform(F.filter("found", lambda c: c["base"]), span).alias("base"), F.transform(F.filter("found", ok), span).alias("spans"))


def joined(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
