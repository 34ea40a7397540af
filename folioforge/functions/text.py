"""Text cleaning and measuring as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes the cleaning rules are defined by.
CONTROL_AND_LATIN1 = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xff]"
# Unicode blanks left once control characters and U+0080-U+00FF are gone.
BLANK = r"[\s\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# All Unicode blanks, for stripping text that was not cleaned before.
ANY_BLANK = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
PATTERN_CHARACTERS = r"[()^+*$|\\?\[\]{}]+"
WORD = r"[\p{L}\p{N}_]{2,}"


def _replace(text: Column, find: str, new: str) -> Column:
    return F.replace(text, F.lit(find), F.lit(new))


def _bracket_quotes(text: Column) -> Column:
    """Curly quotes next to a list bracket become straight ones."""
    return _replace(_replace(text, "[“", '["'), "”]", '"]')


def strip(text: Column) -> Column:
    """Remove blanks of any kind from both ends."""
    return F.btrim(text, F.lit(ANY_BLANK))


def _printable(text: Column, line_ends: str) -> Column:
    """Line ends become blanks, control and Latin-1 characters go, runs of blanks shrink to one.

    Text of printable ASCII only, the usual case, takes a cheaper way to the same result.
    """
    blanks = " " * len(line_ends)
    rest = F.regexp_replace(F.translate(text, line_ends, blanks), CONTROL_AND_LATIN1, "")
    return F.when(
        text.rlike("[^ -~]"), F.regexp_replace(rest, f"{BLANK}{{2,}}", " ")
    ).otherwise(F.regexp_replace(text, " {2,}", " "))


def clean_page_text(text: Column) -> Column:
    """Cleaning applied to paragraphs when pages are split."""
    return _printable(_replace(_bracket_quotes(text), "|", ""), "\n\t")


def clean_qa_text(text: Column) -> Column:
    """Cleaning applied before answers are looked up in paragraphs.

    Blanks are not collapsed again after the deletions, so a second pass may
    change the text once more.
    """
    text = _replace(_replace(_bracket_quotes(text), "“", ""), "”", "")
    text = F.lower(F.regexp_replace(_printable(text, "\n"), PATTERN_CHARACTERS, ""))
    return F.regexp_replace(text, r"\.{2,}", "")


def clean_relevance_text(text: Column) -> Column:
    """Cleaning applied to annotated passages before they are parsed."""
    text = F.translate(F.coalesce(text, F.lit("")), "“”\n\t", '""  ')
    text = F.regexp_replace(text, r"[^\x20-\x7e\n\r\t]", "")
    text = F.regexp_replace(text, r"\s{2,}", " ")
    return _replace(_replace(text, "BOE", ""), "\\", "")


def alnum_count(text: Column) -> Column:
    """Number of letters and numerals."""
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))


def words(text: Column) -> Column:
    """Lower-cased words of two characters or more, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def single_line(text: Column) -> Column:
    """Join the lines with a blank and strip."""
    return strip(F.translate(text, "\n", " "))


def document_stem(file_name: Column) -> Column:
    """Document name without the format suffix."""
    return _replace(file_name, ".pdf", "")


def normalise_pdf_name(name: Column) -> Column:
    """Give every document name exactly one `.pdf` ending."""
    stem = (
        F.when(name.endswith(".pdf"), F.substring_index(name, ".pdf", 1))
        .when(name.endswith(",pdf"), F.substring_index(name, ",pdf", 1))
        .otherwise(name)
    )
    return F.concat(strip(stem), F.lit(".pdf"))
