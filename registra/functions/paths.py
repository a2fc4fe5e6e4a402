"""Where documents of the three sources lie, as Column expressions over their number, heading and ancestors.

``ancestors`` is an array of structs with level_type, identifier, number and heading, the largest level first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registra.functions.identifiers import pad_two
from registra.functions.text import slug


def ancestor(ancestors: Column, *levels: str) -> Column:
    """The first ancestor of the first of these levels that there is one of; null if there is none."""

    def first(level: str) -> Column:
        return F.get(F.filter(ancestors, lambda a: a["level_type"] == level), 0)

    return F.coalesce(*map(first, levels))


def _joined(root: str, *parts: Column) -> Column:
    """Parts behind the root; null ones are left out."""
    return F.concat_ws("/", F.lit(root), *parts)


def title_folder(ancestors: Column, doc_number: Column) -> Column:
    """title-05, or title-05-appendix for the number '5a' and for what lies in a numbered appendix."""
    marked = F.regexp_extract(doc_number, r"(?i)^(\d+)a$", 1)
    inside = ancestor(ancestors, "appendix")
    digits = F.regexp_extract(F.coalesce(inside["number"], doc_number), r"^(\d+)", 1)
    number = F.when(marked != "", marked).when(inside.isNotNull() & (digits != ""), digits)
    plain = F.concat(F.lit("title-"), pad_two(F.coalesce(ancestor(ancestors, "title")["number"], F.lit("00"))))
    return F.coalesce(F.concat(F.lit("title-"), pad_two(number), F.lit("-appendix")), plain)


def chapter_folder(ancestors: Column) -> Column:
    """chapter-05; of compiled acts and plans, which have no number, the heading's slug; null outside of chapters."""
    chapter = ancestor(ancestors, "chapter")
    other = ancestor(ancestors, "compiledAct", "reorganizationPlan")
    default = F.when(ancestor(ancestors, "compiledAct").isNotNull(), "compiled-act").otherwise("reorganization-plan")
    plans = F.when(ancestor(ancestors, "reorganizationPlans").isNotNull(), "reorganization-plans")
    named = F.when(other.isNotNull(), F.coalesce(F.nullif(slug(F.trim(F.coalesce(other["heading"], F.lit(""))), ""), F.lit("")), default))
    return F.coalesce(F.concat(F.lit("chapter-"), pad_two(F.nullif(chapter["number"], F.lit("")))), named, plans)


def code_path(root: str, ancestors: Column, number: Column, suffix: Column, doc_number: Column) -> Column:
    """The file of a section of a code; ``suffix`` tells sections with one number apart."""
    file = F.concat(F.lit("section-"), F.coalesce(number, F.lit("0")), F.coalesce(suffix, F.lit("")), F.lit(".md"))
    return _joined(f"{root}/usc", title_folder(ancestors, doc_number), chapter_folder(ancestors), file)


def regulation_path(root: str, level: Column, ancestors: Column, number: Column, heading: Column) -> Column:
    """The file of a level of the regulations: titles and chapters are flat files, parts lie in chapters, all else in parts."""
    number_of = lambda name: F.nullif(ancestor(ancestors, name)["number"], F.lit(""))
    folder = F.concat(F.lit("title-"), pad_two(F.coalesce(ancestor(ancestors, "title")["number"], number, F.lit("0"))))
    chapter = F.concat(F.lit("chapter-"), number_of("chapter"))
    part = F.concat(F.lit("part-"), number_of("part"))
    own = F.coalesce(number, F.lit("0"))
    named = F.concat(slug(F.coalesce(number, heading, F.lit("appendix")), "appendix"), F.lit(".md"))
    base = f"{root}/ecfr"
    return (
        F.when(level == "title", _joined(base, F.concat(folder, F.lit(".md"))))
        .when(level == "chapter", _joined(base, folder, F.concat(F.lit("chapter-"), own, F.lit(".md"))))
        .when(level == "part", _joined(base, folder, chapter, F.concat(F.lit("part-"), own, F.lit(".md"))))
        .when(level == "appendix", _joined(base, folder, chapter, part, named))
        .otherwise(_joined(base, folder, chapter, part, F.concat(F.lit("section-"), own, F.lit(".md"))))
    )


def register_path(root: str, number: Column, date: Column, kind: str = "md") -> Column:
    """The file of a register document by its date 'YYYY-MM-DD'; ``kind`` is md, xml or json."""
    return _joined(f"{root}/fr", F.split_part(date, F.lit("-"), F.lit(1)), F.split_part(date, F.lit("-"), F.lit(2)), F.concat(number, F.lit(f".{kind}")))
