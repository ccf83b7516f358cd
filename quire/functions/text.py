"""Scalar text operators as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quire import constants as K

WORD = r"[\p{L}\p{N}_]"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_extract(c, r"(?sU)^\s*+(.*\S)", 1)  # one pass from either end, however many spaces lie between


def is_blank(c: Column) -> Column:
    """Whether nothing but white space of any kind is there; null for null."""
    return ~c.rlike(r"(?U)\S")


def expand_ligatures(c: Column, table: dict[str, str] = K.LIGATURES) -> Column:
    for glyph, letters in table.items():
        c = F.replace(c, F.lit(glyph), F.lit(letters))
    return c


def ligature_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[" + "".join(K.LIGATURES) + "]"))


def clean_text(c: Column) -> Column:
    """Drop control characters and soft hyphens, expand ligatures, join broken words and lines; one pass each."""
    c = F.regexp_replace(c, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "")
    c = F.replace(expand_ligatures(c), F.lit("­"), F.lit(""))
    c = F.regexp_replace(c, f"({WORD})-\n({WORD})", "$1$2")
    return F.regexp_replace(c, "([a-z,;])\n([a-z])", "$1 $2")


def references(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(K.REFERENCE), F.lit(0))


def reference_count(c: Column) -> Column:
    """Distinct figure, table and box references of one page."""
    return F.size(F.array_distinct(references(c)))


def annotate_references(c: Column, page: Column) -> Column:
    """A comment that names the page after every reference."""
    return F.regexp_replace(c, F.lit(K.REFERENCE), F.concat(F.lit("$0 <!-- REF: $0 → see PDF page "), page.cast("string"), F.lit(" -->")))


def dose_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(K.DOSE))


def is_continued(c: Column) -> Column:
    return F.coalesce(c.rlike(K.CONTINUED), F.lit(False))


def has_text(c: Column) -> Column:
    """Whether a line other than page markers holds visible text."""
    return F.exists(F.split(c, "\n", -1), lambda x: ~x.rlike(K.PAGE_MARKER) & x.rlike(r"\S"))


def page_markers(c: Column) -> Column:
    marked = F.filter(F.split(c, "\n", -1), lambda x: x.rlike(K.PAGE_MARKER))
    return F.transform(marked, lambda x: F.regexp_extract(x, K.PAGE_MARKER, 1).cast("int"))


def chapter_key(c: Column) -> Column:
    """The token that identifies a heading, whatever its keyword."""
    found = F.regexp_extract(c, K.CHAPTER_KEY, 1)
    return F.when(found != "", F.upper(found)).otherwise(F.substring(c, 1, 20))


def is_chapter_heading(c: Column) -> Column:
    return c.rlike(K.CHAPTER_HEADING) | c.rlike(K.PART_HEADING) | c.rlike(K.SECTION_HEADING) | c.rlike(K.NUMBERED_HEADING)


def looks_like_heading(c: Column) -> Column:
    s = strip(c)
    letters = F.regexp_replace(s, r"[^\p{L}]", "")
    capitals = (F.length(letters) >= 4) & letters.rlike(r"^\p{Lu}+$")
    return (s != "") & (F.length(s) <= K.HEADING_MAX) & (is_chapter_heading(s) | capitals | s.rlike(r"^\d+(?:\.\d+){1,3}\s+[A-Z]"))


def slug(c: Column) -> Column:
    return F.substring(F.replace(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", ""), F.lit(" "), F.lit("_")), 1, 60)


def chapter_file(number: Column, title: Column) -> Column:
    """chNN_Title.md with only letters, digits and underscores."""
    safe = F.replace(F.trim(F.substring(F.regexp_replace(title, "[^a-zA-Z0-9_ ]", ""), 1, 50)), F.lit(" "), F.lit("_"))
    name = F.concat(F.lit("ch"), F.when(number < 10, F.concat(F.lit("0"), number.cast("string"))).otherwise(number.cast("string")))
    return F.concat(name, F.when(safe != "", F.concat(F.lit("_"), safe)).otherwise(""), F.lit(".md"))


def keyword_chapter_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?i)^\s*(?:chapter|chap\.)\s*(\d{1,3})\b", 1), F.lit("")).cast("int")


def chapter_number(c: Column) -> Column:
    """The number written in a title: Chapter N, then a bare N before a title, then a number word."""
    t = strip(c)
    of = lambda pattern: F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))
    keyword = of(r"(?i)^\s*(?:chapter|chap\.?|ch\.?)\s*(\d{1,3})\b").cast("int")
    bare = of(r"^\s*(\d{1,3})(?!\.\d)(?:\s*[.:)_\-–—]\s*|\s+)(?=[^\d\s.])").cast("int")
    word = F.create_map(*[F.lit(x) for pair in K.NUMBER_OF_WORD.items() for x in pair])[F.lower(of(r"(?i)^\s*chapter\s+([a-z]+(?:-[a-z]+)?)\b"))]
    return F.coalesce(keyword, bare, word)


def strip_numbering(c: Column) -> Column:
    roman = r"(?=[ivxlcdm]+\b)m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
    number = (
        r"(?i)^\s*(?:chapter\s*(?:\d{1,3}|[a-z]+(?:-[a-z]+)?)\b|(?:chap|ch)\.?\s*\d{1,3}\b|"
        r"(?:part|section|unit|module)\b\s*(?:\d{1,3}|[ivxlcdm]+|[a-z]+(?:-[a-z]+)?)\b|\d{1,3}(?=[A-Za-z])|"
        r"\d{1,3}(?:\.\d{1,3})*\b|" + roman + r"\.)\s*[.:)\-–—]*\s*"
    )
    return strip(F.regexp_replace(strip(c), number, ""))


def normalise_ascii(c: Column) -> Column:
    """Lower case, runs of anything but letters and digits to one space.  For titles without compositions; see ``normalise``."""
    return F.trim(F.regexp_replace(F.lower(c), "[^0-9a-zÀ-ɏ㐀-鿿]+", " "))


class _Points(dict):
    """What becomes of each code point, worked out when it is first met."""

    def __init__(self, of: Callable[[str], str | None]) -> None:
        self.of = of

    def __missing__(self, point: int) -> str | None:
        self[point] = found = self.of(chr(point))
        return found


_UNMARKED = _Points(lambda x: None if unicodedata.combining(x) else x)
_LETTERS = _Points(lambda x: x if x.isdigit() and x.isascii() or "a" <= x <= "z" or "À" <= x <= "ɏ" or "㐀" <= x <= "鿿" else " ")


def normalised(s: str | None) -> str:
    """NFKD without combining marks, NFKC, casefold, other runs to one space; cut at NUL."""
    s = (s or "").split("\0")[0]
    if not s.isascii():
        s = unicodedata.normalize("NFKC", unicodedata.normalize("NFKD", s).translate(_UNMARKED))
    return " ".join(s.casefold().translate(_LETTERS).split())


@F.arrow_udf(StringType())
def normalise(titles: pa.Array) -> pa.Array:
    """``normalised`` of each title."""
    return pa.array((normalised(s.as_py()) for s in titles), pa.string(), size=len(titles))


def kind_of(normalised: Column) -> Column:
    """references, front, back or body from a normalised title without numbering."""
    return F.when(normalised.rlike(K.REFERENCES_TITLE), "references").when(normalised.rlike(K.FRONT_TITLE), "front").when(normalised.rlike(K.BACK_TITLE), "back").otherwise("body")


def classify_kind(title: Column, normalised=normalise_ascii) -> Column:
    t = normalised(strip_numbering(title))
    return kind_of(F.when(t != "", t).otherwise(normalised(title)))


def html_to_text(c: Column) -> Column:
    """Tags flattened: scripts and styles dropped, blocks to new lines, cells joined, entities decoded, white space squeezed."""
    c = F.regexp_replace(c, r"(?is)<(script|style)\b.*?(?:</\1\s*>|$)", "")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(c, r"(?i)</t[dh]\s*>\s*<t[dh]\b[^>]*>", " | ")
    c = F.regexp_replace(c, r"(?i)</?(?:" + BLOCK_TAGS + r")\b[^>]*>", "\n")
    c = F.regexp_replace(c, r"</?[a-zA-Z!][^>]*>", "")
    for name, char in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(char))
    c = F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), "\r", "\n")
    c = F.regexp_replace(c, "[ \t ]+", " ")
    c = F.regexp_replace(F.regexp_replace(c, "(?m)^ +", ""), "(?m) +$", "")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


# Block-level tags and the entities decoded.
BLOCK_TAGS = "p|div|br|li|ul|ol|h1|h2|h3|h4|h5|h6|section|article|header|footer|nav|main|aside|blockquote|pre|table|tr|thead|tbody|figure|figcaption|hr|dl|dt|dd|title|head|body|html"
ENTITIES = {"&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def file_stem_key(c: Column) -> Column:
    """A file stem without its year, as letters and digits only."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"[ _-]+\d{4}$", "")), "[^a-z0-9]", "")


def figure_id(c: Column) -> Column:
    """The canonical id of a figure: dashes to dots, no spaces, lower case, look-alike letters next to digits read as digits."""
    s = F.regexp_replace(F.regexp_replace(c, r"\s+", ""), "[" + K.DASHES + "]", ".")
    for pattern, digit in (("[lI]", "1"), ("S", "5"), ("O", "0")):
        s = F.regexp_replace(s, rf"(?<=[\d.]){pattern}(?=[\d.]|$)|(?<![A-Za-z]){pattern}(?=[\d.])", digit)
    return F.lower(s)


def is_multipanel(caption: Column) -> Column:
    """Whether two or more different panel letters are named in parentheses."""
    letters = F.regexp_extract_all(caption, F.lit(r"\(([A-Ha-h])\)"), F.lit(1))
    return F.size(F.array_distinct(F.transform(letters, F.upper))) >= 2
