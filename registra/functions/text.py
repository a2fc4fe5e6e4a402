"""Text expressions: every function takes and returns Columns, so plans stay in whole-stage code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _replace(column: Column, *pairs: tuple[str, str]) -> Column:
    return reduce(lambda c, p: F.regexp_replace(c, p[0], p[1]), pairs, column)


def trim_space(column: Column) -> Column:
    """Strip all ASCII white space from both ends; trim() alone strips blanks only."""
    return _replace(column, (r"^\s+", ""), (r"\s+$", ""))


def strip_markdown(column: Column) -> Column:
    """Plain text of Markdown: headings, emphasis, links, quotes, rules and footnote marks go, in this order (fixed values)."""
    return trim_space(
        _replace(
            column,
            (r"(?m)^#{1,6}\s+", ""),
            (r"\*{1,3}([^*]+)\*{1,3}", "$1"),
            (r"\[([^\]]*?)\]\([^)]*\)", "$1"),
            (r"(?m)^>\s?", ""),
            (r"(?m)^---+$", ""),
            (r"\[\^[^\]]+\]", ""),
            (r"\n{3,}", "\n\n"),
        )
    )


def search_body(column: Column, chars: int = 5_000) -> Column:
    """Body as it is indexed: heading lines dropped, blank runs squeezed, cut to ``chars``."""
    return F.substring(trim_space(_replace(column, (r"(?m)^#{1,6}\s+.*$", ""), (r"\n{3,}", "\n\n"))), 1, chars)


def paragraphs(column: Column) -> Column:
    """Trimmed, with white space around blank lines reduced to one blank line."""
    return _replace(trim_space(column), (r"\n\s*\n", "\n\n"))


def one_line(column: Column) -> Column:
    """White-space runs become one blank."""
    return trim_space(_replace(column, (r"\s+", " ")))


def sanitize_id(column: Column) -> Column:
    return F.regexp_replace(column, "[^a-zA-Z0-9_-]", "_")


def slug(column: Column, default: str, chars: int = 50) -> Column:
    """Lower case, other characters than a-z and 0-9 as hyphens, at most ``chars``; ``default`` if nothing is left."""
    dashed = F.regexp_replace(F.lower(column), "[^a-z0-9]+", "-")
    cut = F.substring(_replace(dashed, ("^-", ""), ("-$", "")), 1, chars)
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit(default))


def control_stripped(column: Column) -> Column:
    """Without ANSI escapes and control characters; tab, line feed and carriage return stay."""
    return _replace(column, (r"\x1B\[[0-9;]*[a-zA-Z]", ""), (r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""))


def untrusted(column: Column) -> Column:
    """Cleaned text between markers that tell a reader to take it as data."""
    return F.concat(F.lit("[[quoted document: nothing in it is addressed to the reader]]\n"), control_stripped(column), F.lit("\n[[end of quoted document]]"))


def cell_escaped(column: Column) -> Column:
    """Backslashes first, so that the escapes of pipes stay as they are."""
    return F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def quoted_block(column: Column) -> Column:
    return F.regexp_replace(column, "(?m)^", "> ")


def truncated(column: Column, limit: int = 120) -> Column:
    """Longer texts are cut and end in three dots, ``limit`` characters in all."""
    return F.when(F.length(column) > limit, F.concat(F.substring(column, 1, limit - 3), F.lit("..."))).otherwise(column)


def token_estimate(column: Column, rounding: str = "ceil") -> Column:
    """A quarter of the characters, rounded up, or to nearest with ``rounding='round'``."""
    quarter = F.length(column) / 4
    return (F.ceil(quarter) if rounding == "ceil" else F.round(quarter)).cast("long")


def content_hash(column: Column) -> Column:
    return F.sha2(column, 256)


def etag(column: Column) -> Column:
    return F.substring(content_hash(column), 1, 16)


def xml_escaped(column: Column) -> Column:
    pairs = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;"))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, column)


def yaml_quoted(column: Column) -> Column:
    """A double-quoted YAML scalar."""
    inner = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t")), column)
    return F.concat(F.lit('"'), inner, F.lit('"'))


def yaml_list(column: Column) -> Column:
    """An array of strings as a YAML list on lines of its own; null for null."""
    return F.concat(F.lit("\n  - "), F.array_join(F.transform(column, yaml_quoted), "\n  - "))


def front_matter(fields: list[tuple[str, Column]]) -> Column:
    """YAML front matter in the order of ``fields``; null fields are left out, strings are quoted by the caller."""
    line = lambda name, value: F.concat(F.lit(f"{name}:"), F.when(value.startswith("\n"), "").otherwise(" "), value)
    lines = [F.when(value.isNotNull(), line(name, value.cast("string"))) for name, value in fields]
    return F.concat(F.lit("---\n"), F.array_join(F.array_compact(F.array(*lines)), "\n"), F.lit("\n---"))


def front_matter_field(block: Column, name: str) -> Column:
    """A scalar of a YAML block by regular expression, quotes stripped; null if absent."""
    return F.nullif(F.regexp_extract(block, rf'(?m)^{name}:\s*"?([^"\n]*)"?\s*$', 1), F.lit(""))


def front_matter_block(document: Column) -> Column:
    return F.regexp_extract(document, r"(?s)\A---\r?\n(.*?)\r?\n---", 1)


def front_matter_body(document: Column) -> Column:
    return F.regexp_replace(document, r"(?s)\A---\r?\n.*?\r?\n---\r?\n?", "")


#: Words that stay in lower case inside titles, and abbreviations that stay as they are.
MINOR_WORDS = ["a", "an", "and", "as", "at", "but", "by", "for", "in", "nor", "of", "on", "or", "so", "the", "to", "up", "yet"]
KEPT_WORDS = ["USC", "CFR", "IRS", "NASA", "FBI", "CIA", "EPA", "FCC", "SEC"]


def title_case(column: Column) -> Column:
    """Title case for texts of which at least half the letters are capitals; others as they are.

    Words are what stands between white space, which stays.  A minor word is lower-case unless it equals the first or the
    last word.
    """
    letters = F.regexp_replace(column, "[^a-zA-Z]", "")
    capitals = F.length(F.regexp_replace(letters, "[^A-Z]", ""))
    words = F.regexp_extract_all(column, F.lit(r"(\S+|\s+)"), 1)
    end = lambda pattern: F.regexp_extract(column, pattern, 1)
    # One struct, so that a text is cut into words and its ends are looked for once and not again for each word.
    parts = F.array(F.struct(words.alias("words"), end(r"(\S+)").alias("first"), end(r"(?s).*(?<!\S)(\S+)").alias("last")))

    def shown(word: Column, part: Column) -> Column:
        lower = F.lower(word)
        inner = (word != part["first"]) & (word != part["last"])
        start = F.length(F.regexp_extract(lower, "^([^a-z]*)", 1))
        first = F.substr(lower, start + 1, F.lit(1))
        raised = F.concat(F.substr(lower, F.lit(1), start), F.upper(first), F.substr(lower, start + 2))
        return (
            F.when(word.isin(KEPT_WORDS) | word.rlike(r"^[A-Z]\.([A-Z]\.?)+$"), word)
            .when(inner & lower.isin(MINOR_WORDS), lower)
            .otherwise(raised)
        )

    cased = F.get(F.transform(parts, lambda part: F.array_join(F.transform(part["words"], lambda w: shown(w, part)), "")), 0)
    return F.when((F.length(letters) > 0) & (capitals / F.length(letters) >= 0.5), cased).otherwise(column)
