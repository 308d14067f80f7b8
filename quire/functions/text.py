"""Text functions: Column in, Column out.

Patterns carry ``(?U)`` for Unicode classes and ``(?d)`` where a dot must stop at
``\\n`` only.  Null in, null out, unless a docstring says otherwise.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

_S = r"[\s\x1c-\x1f]"
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"

# Word lists and limits that results depend on.
BOILERPLATE_FIRST = ("https://doi.org/", "received:", "© the author")
BOILERPLATE_WHOLE = ("springer",)
BOILERPLATE_INSIDE = ("extended author information available on the last page of the article", "published online:")
MIN_LETTERS = 6

# Patterns that results depend on.
FIGURE_CAPTION = r"(?iU)^\s*(?:fig(?:ure)?)\.?\s*[:.]?\s*([0-9]+)\b"
TABLE_CAPTION = r"(?iU)^\s*table\s+([0-9]+)\b"
HTML_FIGURE_NUMBER = r"(?isU)<figcaption\b[^>]*>.*?\b(?:fig(?:ure)?)\.?\s*[:.]?\s*([0-9]+)\b"
HTML_FIGURE_CAPTION = r"(?is)<figcaption\b[^>]*>(.*?)</figcaption>"
HTML_TABLE_NUMBER = r"(?isU)<caption\b[^>]*>.*?\btable\s+([0-9]+)\b"
HTML_TABLE_CAPTION = r"(?is)<caption\b[^>]*>(.*?)</caption>"
ALT_TEXT = r'(?i)<img\b[^>]*\balt="([^"]*)"'
BOLD_LEAD = r"(?dU)^\s*\*\*(.+?)\*\*"
STANDALONE_BOLD = r"(?dU)^\s*\*\*(.+?)\*\*\s*\z"
#: What becomes of markup, in this order.
MARKUP = tuple((re.compile(p), to) for p, to in ((r"\$[^$]*\$", " "), (r"\\[a-zA-Z]+", " "), (r"\$", " "), (r'<img\b[^>]*\balt="([^"]*)"[^>]*>', r" \1 "), (r"<[^>]+>", " ")))
PLAIN = (("\u00ad", ""), ("–", "-"), ("—", "-"), ("−", "-"), ("“", '"'), ("”", '"'))
#: A word broken at a line's end, told by the hyphen first: most texts have none.
LINE_HYPHEN = re.compile(r"-[^\S\n]*\n")
BROKEN_WORD = re.compile(r"([a-z]{2})-[^\S\n]*\n\s*([a-z]{2,})")
LONG_WORD = re.compile(rf"\b[a-z]{{{MIN_LETTERS},}}\b")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is named there."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{_S}+|{_S}+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U){_S}+\z", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{_S}+", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U){_S}+", " ")


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def split_lines(c: Column) -> Column:
    """Lines without their ends; a last end makes no further line."""

    def kept(lines: Column) -> Column:
        return F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)

    return let(F.split(c, LINE_ENDS), kept)


def strip_md(c: Column) -> Column:
    """Without images, link targets and emphasis marks, white space collapsed."""
    c = F.regexp_replace(c, r"(?d)!\[.*?\]\(.*?\)", " ")
    c = F.regexp_replace(c, r"\[([^\]]+)\]\([^)]+\)", "$1")
    return strip(collapse(F.translate(c, "*_", "")))


def normalize(c: Column) -> Column:
    """Key for comparing headings: ASCII letters and digits, single spaces."""
    return strip(F.regexp_replace(F.lower(strip_md(c)), "[^a-z0-9]+", " "))


def plain_words(plain: Column) -> Column:
    return F.regexp_count(plain, F.lit(r"(?U)\b\w+\b"))


def word_count(c: Column) -> Column:
    return plain_words(strip_md(c))


def _int(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("int")


def group(c: Column, pattern: str, index: int = 1) -> Column:
    """A group of the first match; null if there is no match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, index))


def _captioned(c: Column, pattern: str) -> Column:
    named = lambda plain: F.struct(_int(F.regexp_extract(plain, pattern, 1)).alias("number"), F.nullif(plain, F.lit("")).alias("caption"))
    return let(strip_md(c), named)


def figure_number(c: Column) -> Column:
    """struct(number, caption) of a text that starts like a figure caption."""
    return _captioned(c, FIGURE_CAPTION)


def table_number(c: Column) -> Column:
    return _captioned(c, TABLE_CAPTION)


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML entities to characters (no built-in does this)."""
    return s.map(html.unescape, na_action="ignore")


def _html_caption(c: Column, number: str, inner: str) -> Column:
    text = unescape(strip(F.regexp_replace(group(c, inner), "<[^>]+>", "")))
    return F.struct(_int(F.regexp_extract(c, number, 1)).alias("number"), F.nullif(text, F.lit("")).alias("caption"))


def html_figure(c: Column) -> Column:
    """struct(number, caption) from a figure's markup; the number may follow the caption."""
    return _html_caption(c, HTML_FIGURE_NUMBER, HTML_FIGURE_CAPTION)


def html_table(c: Column) -> Column:
    return _html_caption(c, HTML_TABLE_NUMBER, HTML_TABLE_CAPTION)


def alt_text(c: Column) -> Column:
    return F.nullif(strip(unescape(group(c, ALT_TEXT))), F.lit(""))


def bold_lead(c: Column) -> Column:
    return strip(group(c, BOLD_LEAD))


def standalone_bold(c: Column) -> Column:
    """Content that is nothing but bold; inner marks may remain."""
    return strip(group(c, STANDALONE_BOLD))


def strip_emphasis(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"^[*_]+|[*_]+\z", ""))


def has_leading_word(normalized: Column, targets: list[str], first: int = 3) -> Column:
    return F.arrays_overlap(F.slice(F.split(normalized, " "), 1, first), F.array(*map(F.lit, targets)))


def ends_broken(c: Column) -> Column:
    def judge(t: Column) -> Column:
        return F.when(t == "", False).when(t.rlike(r"[-,]\z"), True).when(t.rlike(r"[.!?]\z"), False).otherwise(word_count(t) > 3)

    return let(rstrip(c), judge)


def starts_broken(c: Column) -> Column:
    return c.rlike(rf"(?U)^{_S}*\p{{IsLowercase}}")


def join_parts(left: Column, right: Column) -> Column:
    a, b = rstrip(left), lstrip(right)
    return F.when(a.endswith("-"), F.concat(F.regexp_replace(a, r"-\z", ""), b)).otherwise(F.concat(a, F.lit(" "), b))


def table_identifier(number: Column, caption: Column) -> Column:
    """The number, else the caption made fit for a file name (possibly empty)."""
    safe = F.substring(F.regexp_replace(caption, r'[\\/*?:"<>| ]', "_"), 1, 50)
    return F.coalesce(number.cast("string"), F.when(caption != "", F.regexp_replace(safe, r"^_+|_+\z", "")))


# Normalizing is plain Python, one pass over a text and no Column for each step: NFKC and
# unescaping need a worker anyway, and Python's classes of letters are the reference's.


def base_text(t: str) -> str:
    """Unescaped, lowered, then NFKC (in this order); plain dashes and quotes, no markup."""
    t = unicodedata.normalize("NFKC", html.unescape(t).lower())
    for mark, to in PLAIN:
        t = t.replace(mark, to)
    for pattern, to in MARKUP:
        t = pattern.sub(to, t)
    return t


def without_boilerplate(t: str) -> str:
    """Lines stripped, publisher lines dropped, blank ones kept."""

    def kept(line: str) -> bool:
        low = line.lower()
        return not (low in BOILERPLATE_WHOLE or low.startswith(BOILERPLATE_FIRST) or any(x in low for x in BOILERPLATE_INSIDE))

    lines, low = [line.strip() for line in t.splitlines()], t.lower()
    if any(x in low for x in (*BOILERPLATE_FIRST, *BOILERPLATE_WHOLE, *BOILERPLATE_INSIDE)):
        lines = filter(kept, lines)
    return "\n".join(lines)


def _digital(t: str) -> str:
    t = without_boilerplate(base_text(t))
    return BROKEN_WORD.sub(r"\1\2", t) if LINE_HYPHEN.search(t) else t


def _extracted(t: str) -> str:
    return without_boilerplate(base_text(t))


def _flat(t: str) -> str:
    """Runs of white space to one space each, then hyphens to spaces."""
    first, last = (" " if t[i : i + 1 or None].isspace() else "" for i in (0, -1))
    return ((first + " ".join(t.split()) + last) if not t.isspace() else " ").replace("-", " ")


def words_in(t: str) -> list[str]:
    return LONG_WORD.findall(t)


def digital_words(t: str) -> list[str]:
    """Long words of a page's text layer; white space and hyphens are none, so they stay."""
    return words_in(_digital(t))


def extracted_words(t: str) -> list[str]:
    return words_in(_extracted(t))


def _by_workers(body: Callable, kind: DataType) -> Callable[[Column], Column]:
    @F.pandas_udf(kind)
    def run(s: pd.Series) -> pd.Series:
        return s.map(body, na_action="ignore")

    return run


base_normalize = _by_workers(base_text, StringType())
drop_boilerplate = _by_workers(without_boilerplate, StringType())
#: Text layer of a page: as below, and words broken at line ends mended.
normalize_digital = _by_workers(lambda t: _flat(_digital(t)), StringType())
normalize_extracted = _by_workers(lambda t: _flat(_extracted(t)), StringType())
long_words = _by_workers(words_in, ArrayType(StringType()))
