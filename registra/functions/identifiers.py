"""Identifiers, numbers, paths and links as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FR = r"^/(\w+)/(fr)/([^/]+)$"
_TITLED = r"^/(\w+)/(usc|cfr)/t(\w+)(?:/s([^/]+)(?:/(.+))?)?$"
#: Pages of publishers that a reference leads to when its target is not in the corpus.
FALLBACKS = {
    "usc": ("https://uscode.house.gov/view.xhtml?req=granuleid:USC-prelim-title", "-section"),
    "cfr": ("https://www.ecfr.gov/current/title-", "/section-"),
    "fr": ("https://www.federalregister.gov/d/", ""),
}


def _part(column: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(column, pattern, group), F.lit(""))


def parse_identifier(column: Column) -> Column:
    """Struct of jurisdiction, code, title, section, sub_path; all null for identifiers of other grammars."""
    fr = column.rlike(_FR)
    return F.struct(
        F.when(fr, _part(column, _FR, 1)).otherwise(_part(column, _TITLED, 1)).alias("jurisdiction"),
        F.when(fr, F.lit("fr")).otherwise(_part(column, _TITLED, 2)).alias("code"),
        F.when(~fr, _part(column, _TITLED, 3)).alias("title"),
        F.when(fr, _part(column, _FR, 3)).otherwise(_part(column, _TITLED, 4)).alias("section"),
        F.when(~fr, _part(column, _TITLED, 5)).alias("sub_path"),
    )


def section_identifier(column: Column) -> Column:
    """The section that an identifier lies in, or null."""
    section = _part(column, r"^/\w+/((?:usc|cfr)/t\w+/s[^/]+)(?:/.+)?$", 1)
    return F.concat(F.lit("/us/"), section)


def resolve_identifier(column: Column, prefix: str) -> Column:
    """Percent-decoded; what does not begin with /us/ gets ``prefix``."""
    decoded = F.try_url_decode(column)
    return F.when(decoded.startswith("/us/"), decoded).otherwise(F.concat(F.lit(prefix), decoded))


def fallback_url(column: Column) -> Column:
    """The publisher's page of an identifier; null for identifiers of other grammars."""
    out = F.when(column.rlike(_FR), F.regexp_replace(column, _FR, FALLBACKS["fr"][0] + "$3"))
    for code in ("usc", "cfr"):
        base, join = FALLBACKS[code]
        section, title = rf"^/\w+/{code}/t(\w+)/s([^/]+)(?:/.+)?$", rf"^/\w+/{code}/t(\w+)$"
        out = out.when(column.rlike(section), F.regexp_replace(column, section, f"{base}$1{join}$2"))
        out = out.when(column.rlike(title), F.regexp_replace(column, title, f"{base}$1"))
    return out


def leading_int(column: Column) -> Column:
    """The integer that a text begins with, or null."""
    return F.regexp_extract(column, r"^\s*([+-]?\d+)", 1).try_cast("int")


def pad_two(column: Column) -> Column:
    """The leading integer with two digits at least; texts without one as they are."""
    n = leading_int(column).cast("string")
    return F.coalesce(F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n), column)


def roman(column: Column) -> Column:
    """Value of a Roman numeral; characters that are no numerals count nothing."""
    values = F.create_map(*[F.lit(x) for pair in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in pair])
    digits = F.transform(F.split(column, ""), lambda c: F.coalesce(F.try_element_at(values, c), F.lit(0)))
    signed = F.transform(digits, lambda d, i: F.when(d < F.coalesce(F.get(digits, i + 1), F.lit(0)), -d).otherwise(d))
    return F.aggregate(signed, F.lit(0), lambda a, d: a + d)


def release_point(column: Column, suffix: bool = False) -> Column:
    """Like 119-73, with ``suffix`` like 119-73not60; other texts as they are, empty ones 'unknown'."""
    found = _part(column, r"(\d+-\d+(?:not\d+)?)" if suffix else r"(\d+-\d+)", 1)
    return F.coalesce(found, F.nullif(column, F.lit("")), F.lit("unknown"))


def release_path(column: Column) -> Column:
    """A release point as two folders, split at its first hyphen."""
    return F.regexp_replace(column, "^([^-]*)-", "$1/")


#: API names of document types that are not their own in lower case.
DOCUMENT_TYPES = {"Rule": "rule", "Proposed Rule": "proposed_rule", "Notice": "notice", "Presidential Document": "presidential_document"}


def document_type(column: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in DOCUMENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, column), F.regexp_replace(F.lower(column), r"\s+", "_"))


def heading_stripped(column: Column) -> Column:
    """A heading without 'CHAPTER I—' or 'Title 1—' and without '--Volume 1', unless nothing would be left."""
    level = r"(?i)^(?:CHAPTER|PART|SUBCHAPTER|SUBPART|SUBTITLE|DIVISION|ARTICLE)\s+[A-Za-z0-9]+\s*[—–-]\s*"
    title = r"(?i)^Title\s+\d+\s*[—–-]\s*"
    plain = F.regexp_replace(F.regexp_replace(column, r"^\s+", ""), r"\s+$", "")
    without_title = F.trim(F.regexp_replace(F.regexp_replace(column, title, ""), r"(?is)--Volume\s.*$", ""))
    stripped = (
        F.when(column.rlike(level), F.trim(F.regexp_replace(column, level, ""))).when(column.rlike(title), without_title).otherwise(plain)
    )
    return F.coalesce(F.nullif(stripped, F.lit("")), plain)


def relative_path(source: Column, target: Column) -> Column:
    """Path from the folder of one file to another file, both relative to one root."""
    a, b = F.split(source, "/"), F.split(target, "/")
    folders = F.size(a) - 1
    same = F.transform(F.sequence(F.lit(1), F.greatest(folders, F.lit(1))), lambda i: F.coalesce((i <= folders) & (i < F.size(b)) & (F.get(a, i - 1) == F.get(b, i - 1)), F.lit(False)))
    first_other = F.array_position(same, F.lit(False)).cast("int")
    common = F.when(first_other > 0, first_other - 1).otherwise(F.size(same))
    common = F.least(common, folders)
    return F.concat(F.repeat(F.lit("../"), folders - common), F.array_join(F.slice(b, common + 1, F.size(b) - common), "/"))


def breadcrumb_paths(base: str, segments: Column) -> Column:
    """The path up to and with each segment."""
    return F.transform(segments, lambda s, i: F.concat(F.lit(f"{base}/"), F.array_join(F.slice(segments, F.lit(1), i + 1), "/")))


def segment_label(segment: Column) -> Column:
    """'title-5' as 'Title 5' and so on; other segments as they are."""
    value = F.regexp_replace(segment, "^[^-]*-?", "")
    out = segment
    for prefix, shown in (("title", "Title "), ("chapter", "Chapter "), ("part", "Part "), ("section", "§ ")):
        out = F.when(F.split_part(segment, F.lit("-"), F.lit(1)) == prefix, F.concat(F.lit(shown), value)).otherwise(out)
    return out


def json_array(column: Column) -> Column:
    """An array of strings from JSON text; null where it is malformed."""
    return F.from_json(column, "array<string>")


def cfr_reference(title: Column, part: Column) -> Column:
    return F.concat(title.cast("string"), F.lit(" CFR Part "), part.cast("string"))
