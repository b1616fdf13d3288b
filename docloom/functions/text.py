"""Scalar rules over text columns. Those that go through whole texts with patterns are Arrow's own kernels in Arrow batches, chained in one pass through Python where one follows
another: a pattern of theirs costs a fraction of Java's. The others are expressions of Spark's."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .classes import KERNEL_W, KERNEL_WS, KERNEL_WS_CHARS, LINE_BREAK_CHARS, NOT_WS, W_CHARS, WS, WS_CHARS, D, W

#: Substrings that a file title must not contain.
PROHIBITED = ("arxiv", "https", "untitled", "www")
#: Titles of documents without one.
UNKNOWN_TITLE, UNTITLED, UNKNOWN = "unknown_title", "Untitled", "Unknown"
#: Texts that a kernel sees at a time; a batch of Spark's has up to 10,000.
ROWS = 1000


def _kernels(rule: Callable[[pa.Array], pa.Array]) -> Callable[[Column], Column]:
    """A rule over arrays of strings as one over columns. Nulls stay null; where a rule can't read what isn't UTF-8, U+FFFD stands for it."""

    def part(texts: pa.Array) -> pa.Array:
        try:
            return rule(texts)
        except (pa.ArrowInvalid, UnicodeDecodeError):
            return rule(pa.array(listed(texts), texts.type))

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(texts.slice(at, ROWS)) for at in range(0, len(texts), ROWS)] or [texts])

    return run


def listed(texts: pa.Array) -> list[str | None]:
    """Python's own strings, with U+FFFD for what isn't UTF-8."""
    try:
        return texts.to_pylist()
    except UnicodeDecodeError:
        return [t.decode(errors="replace") if t is not None else None for t in texts.cast(pa.binary()).to_pylist()]


def _sub(texts: pa.Array, pattern: str, to: str) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern, to)


def _where(texts: pa.Array, pattern: str, rule: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """rule of the texts in which the pattern is found, and the others as they are."""
    found = pc.match_substring_regex(texts, pattern).fill_null(False)
    return pc.replace_with_mask(texts, found, rule(texts.filter(found))) if found.true_count else texts


def _stripped(texts: pa.Array) -> pa.Array:
    return _where(texts, f"^{KERNEL_WS}|{KERNEL_WS}$", lambda some: _sub(some, f"^{KERNEL_WS}+|{KERNEL_WS}+$", ""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+\\z", "")


def words(c: Column) -> Column:
    """Words between white space, none of them empty."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def unix_lines(c: Column) -> Column:
    """\\r\\n and \\r as \\n, as text files are read."""
    return F.regexp_replace(c, "\r\n?", "\n")


# --- repair of OCR text -------------------------------------------------------------------------


def _repaired(texts: pa.Array) -> pa.Array:
    # the ends of a word are characters of the match here, so of two words that share one the second goes at the second go
    word = lambda some: _sub(some, f"(?i)(^|[^{W_CHARS}])NUL($|[^{W_CHARS}])", r"\1\2")
    texts = _where(texts, "(?i)NUL", lambda some: word(word(some)))
    texts = _sub(texts, rf"\x00|{D}{{6,}}", "")
    # a run of [\n\t] becomes a space, and then a run of white space: what is left of a run is a space unless it is one other character
    texts = _sub(texts, rf"{KERNEL_WS}{{2,}}|[\n\t]", " ")
    return _stripped(_where(texts, r"\.\.", lambda some: _sub(some, r"\.{2,}", ".")))


def clean_ocr_text(c: Column) -> Column:
    """Drops the word NUL, NUL characters and runs of six digits or more; makes runs of white space one space, and runs of dots one dot; strips."""
    return _kernels(_repaired)(c)


# --- normalisation ------------------------------------------------------------------------------


def _nfc(texts: pa.Array) -> pa.Array:
    return _where(texts, r"[\x{300}-\x{10ffff}]", lambda some: pa.array([unicodedata.normalize("NFC", t) for t in some.to_pylist()], texts.type))


def _spaced(texts: pa.Array) -> pa.Array:
    return _sub(_sub(texts, f"{KERNEL_WS}+([.,;!?])", r"\1"), f"([.,!?;:])({KERNEL_W})", r"\1 \2")


def _single_spaced(texts: pa.Array) -> pa.Array:
    # a run of blanks becomes a space, and then a run of white space: what is left of a run is a space unless it is one other character
    return _stripped(_sub(texts, rf"{KERNEL_WS}{{2,}}|\t", " "))


def _plain_quotes(texts: pa.Array) -> pa.Array:
    return _where(texts, "[“”‘’]", lambda some: _sub(_sub(some, "[“”]", '"'), "[‘’]", "'"))


def nfc(c: Column) -> Column:
    """Unicode normal form C. Characters below U+0300 are in that form already, so only texts with others are looked at one by one."""
    return _kernels(_nfc)(c)


def fix_punctuation_spacing(c: Column) -> Column:
    """No white space before . , ; ! ? and one space between . , ! ? ; : and a word character."""
    return _kernels(_spaced)(c)


def remove_redundant_whitespace(c: Column) -> Column:
    """Runs of blanks, and of white space, become one space; a single line end stays."""
    return _kernels(_single_spaced)(c)


def ensure_consistent_quotes(c: Column) -> Column:
    return _kernels(_plain_quotes)(c)


def normalize_text(c: Column) -> Column:
    """Normal form C, punctuation spacing, white space and quotes, in this order."""
    return _kernels(lambda texts: _plain_quotes(_single_spaced(_spaced(_nfc(texts)))))(c)


# --- titles -------------------------------------------------------------------------------------


def file_title(meta_title: Column, first_page: Column) -> Column:
    """The metadata title if there is one, else the first line of the first page that isn't blank; cleaned, or unknown_title."""
    line = F.nullif(strip(F.regexp_extract(first_page, f"^{WS}*([^\\n]*)", 1)), F.lit(""))  # white space before it may hold line ends
    t = F.lower(F.coalesce(F.nullif(meta_title, F.lit("")), line, F.lit(UNKNOWN_TITLE)))
    t = F.regexp_replace(F.regexp_replace(t, f"{D}+", ""), f"[^{W_CHARS}{WS_CHARS}]", "")
    t = F.regexp_replace(strip(t), f"{WS}+", "_")
    for s in PROHIBITED:
        t = F.replace(t, F.lit(s), F.lit(""))
    return F.coalesce(F.nullif(F.regexp_replace(t, "^_+|_+\\z", ""), F.lit("")), F.lit(UNKNOWN_TITLE))


def clean_title(c: Column) -> Column:
    """Lower-case letters, digits and words joined by underscores; a number stays only as a year from 1900 to 2100."""
    w = words(F.regexp_replace(F.lower(c), f"[^a-z0-9{WS_CHARS}]", ""))
    year = lambda x: F.coalesce(x.try_cast("int").between(1900, 2100), F.lit(False))
    return F.array_join(F.filter(w, lambda x: ~x.rlike("^[0-9]+$") | year(x)), "_")


def first_line_title(c: Column) -> Column:
    """The first line that is neither blank nor starts with http or www, 200 characters of it at most; Untitled if there is none."""
    rest = f"[^{LINE_BREAK_CHARS}]"
    # line ends are white space too; possessive, so that what was passed over is neither held nor tried again; of a long line no more than its start is looked at
    line = f"{rest}{{200}}(?=[{WS}&&{rest}]*+{NOT_WS})|{rest}{{0,199}}{NOT_WS}"
    return F.coalesce(F.nullif(F.regexp_extract(c, f"\\A(?:{WS}*+(?i:http|www){rest}*+)*+{WS}*+({line})", 1), F.lit("")), F.lit(UNTITLED))


# --- identifiers --------------------------------------------------------------------------------


def id_from_name(c: Column) -> Column:
    """Six digits in brackets, or null."""
    return F.nullif(F.regexp_extract(c, rf"\[({D}{{6}})\]", 1), F.lit(""))


def id_from_chunk_name(c: Column) -> Column:
    """Six digits in brackets, else the number before the extension (and before a second number), else unknown."""
    number = F.nullif(F.regexp_extract(c, rf"_({D}+)(?:_{D}+)?\.txt$", 1), F.lit(""))
    return F.coalesce(id_from_name(c), number, F.lit("unknown"))


def with_id(base: Column, unique_id: Column) -> Column:
    """The base name with its id in brackets, unless it holds the id, in brackets or not."""
    return F.when(F.contains(base, unique_id), base).otherwise(F.concat(base, F.lit(" ["), unique_id, F.lit("]")))


# --- metadata scalars ---------------------------------------------------------------------------


def _plain(texts: pa.Array) -> pa.Array:
    # two capital letters have small ones that depend on more than themselves
    plain = _sub(texts, f"[^{W_CHARS}{KERNEL_WS_CHARS}]+", "")
    found = pc.match_substring_regex(plain, "[İΣ]").fill_null(False)
    small = pc.utf8_lower(plain)
    return _stripped(pc.replace_with_mask(small, found, pa.array([t.lower() for t in plain.filter(found).to_pylist()], plain.type)) if found.true_count else small)


def counted(texts: pa.Array) -> pa.Array:
    """How many words() each text has."""
    return pc.count_substring_regex(texts, f"[^{KERNEL_WS_CHARS}]+").cast(pa.int32())


def _skipped(texts: pa.Array, n: int) -> pa.Array:
    long = pc.greater(counted(texts), n).fill_null(False)
    if not long.true_count:
        return texts
    spaced = _sub(_stripped(texts.filter(long)), f"{KERNEL_WS}+", " ")
    return pc.replace_with_mask(texts, long, pc.list_element(pc.split_pattern(spaced, " ", max_splits=n), n))


def strip_punct_lower(c: Column) -> Column:
    """Word characters and white space only, lower-cased and stripped: the text side of keyword matching."""
    return _kernels(_plain)(c)


def skip_words(c: Column, n: int = 500) -> Column:
    """What follows the first n words, joined by single spaces; a text of n words or less as it is."""
    return _kernels(lambda texts: _skipped(texts, n))(c)


def keyword_text(c: Column, n: int = 500) -> Column:
    """skip_words() of strip_punct_lower()."""
    return _kernels(lambda texts: _skipped(_plain(texts), n))(c)


def year(c: Column) -> Column:
    """The first word that is a year of the 20th or 21st century, else Unknown."""
    # what is before it is looked at last, as that costs most
    return F.coalesce(F.nullif(F.regexp_extract(c, f"([12][90](?<=19|20){D}{{2}})(?!{W})(?<!{W}(?:19|20){D}{{2}})", 1), F.lit("")), F.lit(UNKNOWN))


def clean_year(c: Column) -> Column:
    return F.when(c.rlike(f"^{D}{{4}}$"), c).otherwise(F.lit(UNKNOWN))


def clean_tags(c: Column) -> Column:
    """Distinct tags in a fixed order."""
    return F.array_sort(F.array_distinct(c))
