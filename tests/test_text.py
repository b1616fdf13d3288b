"""Text rules against plain Python on edge strings and random ones; Python's own regular expressions are the judge."""

import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import text as X
from docloom.operators import identity
from docloom.plans import catalog

ALPHABET = list("aZ09 .,;:!?_-“”‘’'\"`\n\t\r\x1c\x85  éÉ½²٣́") + ["NUL", "nul", "123456", "1999", "2001", "http", "www.", "..", "  ", "é", "\x00"]


def strings(n=400, seed=1):
    rng = random.Random(seed)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return made + [t for _, t in catalog.TEXTS] + [t for t in catalog.TITLES]


def clean_ocr(t):
    for pattern, to, flags in ((r"\bNUL\b", "", re.I), (r"\x00|\d{6,}", "", 0), (r"[\n\t]+", " ", 0), (r"\s{2,}", " ", 0), (r"\.{2,}", ".", 0)):
        t = re.sub(pattern, to, t, flags=flags)
    return t.strip()


def normal(t):
    t = unicodedata.normalize("NFC", t)
    t = re.sub(r"([.,!?;:])(\w)", r"\1 \2", re.sub(r"\s+([.,;!?])", r"\1", t))
    t = re.sub(r"\s{2,}", " ", re.sub(r"[ \t]+", " ", t)).strip()
    return t.translate({0x201C: '"', 0x201D: '"', 0x2018: "'", 0x2019: "'"})


def plain(t):
    return re.sub(r"[^\w\s]", "", t).lower().strip()


def skip(t, n=3):
    w = t.split()
    return " ".join(w[n:]) if len(w) > n else t


def year(t):
    m = re.search(r"\b(19|20)\d{2}\b", t)
    return m.group(0) if m else "Unknown"


def first_line(t):
    good = (x.strip() for x in t.splitlines() if x.strip() and not re.match("(http|www)", x.strip(), re.I))
    return next(good, "Untitled")[:200]


def title(t):
    w = re.sub(r"[^a-z0-9\s]", "", t.lower()).split()
    return "_".join(x for x in w if not x.isdigit() or 1900 <= int(x) <= 2100)


RULES = [(X.clean_ocr_text, clean_ocr), (X.normalize_text, normal), (X.strip_punct_lower, plain), (lambda c: X.skip_words(c, 3), skip), (X.year, year), (X.first_line_title, first_line), (X.clean_title, title), (X.strip, str.strip)]


@pytest.mark.parametrize("k", range(len(RULES)))
def test_rule(spark, k):
    rule, want = RULES[k]
    texts = strings()
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", rule(F.col("t")).alias("out")).collect()
    bad = [(texts[r.i], r.out, want(texts[r.i])) for r in got if r.out != want(texts[r.i])]
    assert not bad, bad[:3]


def test_nulls_stay_null(spark):
    row = spark.createDataFrame([(None,)], "t string").select(*[r(F.col("t")).alias(f"c{i}") for i, (r, _) in enumerate(RULES)]).first()
    assert row.c0 is None and row.c1 is None and row.c2 is None and row.c3 is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join))
def test_normal_form_is_stable(t):
    assert normal(normal(t)) == normal(t)


def test_file_title_is_never_empty_and_has_no_digits(spark):
    rows = [(t, p) for t in ["", None, "A 1 b", "www", "_x_", "https www"] for p in ["", None, " \nline 2\n", "arXiv"]]
    out = spark.createDataFrame(rows, "m string, p string").select("m", "p", X.file_title(F.col("m"), F.col("p")).alias("t")).collect()
    assert all(r.t and not re.search(r"\d", r.t) and "www" not in r.t for r in out)
    assert {(r.m, r.p): r.t for r in out}["A 1 b", None] == "a_b" and {(r.m, r.p): r.t for r in out}["", " \nline 2\n"] == "line"


@pytest.mark.parametrize(("path", "want"), [("a/b/c.d.pdf", "c.d"), ("c", "c"), (".hidden", ".hidden"), ("x\\y [1].pdf", "y [1]"), ("a.b/c", "c")])
def test_stem(spark, path, want):
    assert spark.createDataFrame([(path,)], "p string").select(identity.stem(F.col("p"))).first()[0] == want


def test_with_id(spark):
    row = spark.createDataFrame([("a", "123456"), ("a [123456]", "123456")], "b string, i string").select(X.with_id(F.col("b"), F.col("i")).alias("x")).collect()
    assert [r.x for r in row] == ["a [123456]"] * 2


@pytest.mark.parametrize(("rule", "want"), [(X.clean_ocr_text, clean_ocr), (X.normalize_text, normal), (X.strip_punct_lower, plain)])
def test_letters_and_digits_of_newer_unicode(spark, rule, want):
    """Letters and digits younger than the JVM's tables are letters and digits to Python, and to SQL."""
    texts = ["a.\U0001e4d0 \U0001e4d0NUL NUL\U00010570", "\U00011f50\U00011f51" * 3 + " x", "\U00012fec,\U00012fec!"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", rule(F.col("t")).alias("out")).collect()
    assert {r.i: r.out for r in got} == {i: want(t) for i, t in enumerate(texts)}


def test_more_rows_than_a_kernel_sees(spark):
    n = 2 * X.ROWS + 1
    rule = lambda c: X.keyword_text(X.normalize_text(X.clean_ocr_text(c)), 3)
    rows = spark.range(n).repartition(1).select("id", rule(F.when(F.col("id") % 7 > 0, F.concat(F.lit("İ Σας\t- NUL. "), F.col("id").cast("string"), F.lit("  Ab,c")))).alias("t")).collect()
    assert {r.id: r.t for r in rows} == {i: skip(plain(normal(clean_ocr(f"İ Σας\t- NUL. {i}  Ab,c")))) if i % 7 else None for i in range(n)}


def test_broken_utf8_is_no_error(spark):
    rows = spark.sql("SELECT CAST(X'20ff2e2e41ff' AS STRING) AS t").select(*[rule(F.col("t")).alias(f"c{i}") for i, (rule, _) in enumerate(RULES[:4])]).select(*[F.hex(f"c{i}") for i in range(4)])
    assert all(rows.first())
