"""Front matter and metadata of the three sources, resource names and links of listings, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import urlencode

from pyspark.sql import Column
from pyspark.sql import functions as F

from registra.functions.identifiers import json_array, leading_int, release_point
from registra.functions.dates import date_part
from registra.functions.paths import ancestor
from registra.functions.text import front_matter, yaml_list, yaml_quoted

#: The fields of front matter in their order, and how those that are no quoted strings are written.
FIELDS = [
    "identifier", "source", "legal_status", "title", "title_number", "title_name", "section_number", "section_name",
    "chapter_number", "chapter_name", "subchapter_number", "subchapter_name", "part_number", "part_name",
    "positive_law", "currency", "last_updated", "format_version", "generator", "source_credit", "status",
    "chapter_count", "section_count", "total_token_estimate", "part_count",
    "authority", "regulatory_source", "agency", "cfr_part", "cfr_subpart",
    "document_number", "document_type", "fr_citation", "fr_volume", "publication_date", "agencies", "cfr_references",
    "docket_ids", "rin", "effective_date", "comments_close_date", "fr_action",
]
PLAIN = {"title_number", "chapter_number", "positive_law", "chapter_count", "section_count", "total_token_estimate", "part_count", "fr_volume"}
LISTS = {"agencies", "cfr_references", "docket_ids"}
FORMAT_VERSION, GENERATOR = "1.1.0", "registra"


def block(fields: Mapping[str, Column]) -> Column:
    """The front matter of these fields in the fixed order; null fields are left out."""
    given = {"format_version": F.lit(FORMAT_VERSION), "generator": F.lit(GENERATOR)} | dict(fields)
    unknown = given.keys() - set(FIELDS)
    if unknown:
        raise ValueError(f"no fields of front matter: {sorted(unknown)}")
    shown = lambda n, c: c.cast("string") if n in PLAIN else yaml_list(c) if n in LISTS else yaml_quoted(c.cast("string"))
    return front_matter([(n, shown(n, given[n])) for n in FIELDS if n in given])


def _name(level: Column) -> Column:
    return F.trim(level["heading"])


def _places(ancestors: Column) -> dict[str, Column]:
    chapter, sub, part = ancestor(ancestors, "chapter", "compiledAct", "reorganizationPlan"), ancestor(ancestors, "subchapter"), ancestor(ancestors, "part")
    return {
        "chapter_number": leading_int(chapter["number"]), "chapter_name": _name(chapter),
        "subchapter_number": F.nullif(sub["number"], F.lit("")), "subchapter_name": _name(sub),
        "part_number": F.nullif(part["number"], F.lit("")), "part_name": _name(part),
    }


def code_fields(number: Column, heading: Column, ancestors: Column, identifier: Column, status: Column, source_credit: Column, meta: Mapping[str, Column]) -> dict[str, Column]:
    """Of a section of a code; ``meta`` has doc_number, dc_title, publication_name, created and positive_law of its document."""
    title = ancestor(ancestors, "title", "appendix")
    title_number = F.coalesce(leading_int(F.regexp_replace(F.coalesce(meta["doc_number"], title["number"], F.lit("0")), "(?i)a$", "")), F.lit(0))
    own, name = F.coalesce(number, F.lit("0")), F.trim(F.coalesce(heading, F.lit("")))
    law = F.coalesce(meta["positive_law"], F.lit(False))
    return _places(ancestors) | {
        "source": F.lit("usc"),
        "legal_status": F.when(law, "official_legal_evidence").otherwise("official_prima_facie"),
        "identifier": F.coalesce(identifier, F.concat(F.lit("/us/usc/t"), title_number.cast("string"), F.lit("/s"), own)),
        "title": F.concat(title_number.cast("string"), F.lit(" USC § "), own, F.lit(" - "), name),
        "title_number": title_number,
        "title_name": F.coalesce(_name(title), meta["dc_title"], F.lit("")),
        "section_number": own,
        "section_name": name,
        "positive_law": law,
        "currency": release_point(F.coalesce(meta["publication_name"], F.lit(""))),
        "last_updated": date_part(F.coalesce(meta["created"], F.lit(""))),
        "source_credit": F.nullif(source_credit, F.lit("")),
        "status": F.nullif(status, F.lit("")),
    }


def regulation_fields(
    level: Column, number: Column, heading: Column, ancestors: Column, identifier: Column, status: Column, source_credit: Column, authority: Column, regulatory_source: Column, currency: Column
) -> dict[str, Column]:
    """Of a section, part or title of the regulations; ``currency`` is the date of the corpus."""
    title = ancestor(ancestors, "title")
    title_number = F.coalesce(leading_int(F.coalesce(title["number"], number, F.lit("0"))), F.lit(0))
    own, name = F.coalesce(number, F.lit("0")), F.trim(F.coalesce(heading, F.lit("")))
    title_name = F.trim(F.coalesce(F.when(level == "title", heading).otherwise(title["heading"]), F.lit("")))
    n = title_number.cast("string")
    display = (
        F.when(level == "title", F.concat(F.lit("Title "), n, F.lit(" — "), title_name))
        .when(level == "part", F.concat(n, F.lit(" CFR Part "), own, F.lit(" - "), name))
        .otherwise(F.concat(n, F.lit(" CFR § "), own, F.lit(" - "), name))
    )
    places, is_part = _places(ancestors), level == "part"
    part_number = F.coalesce(places["part_number"], F.when(is_part, own))
    numbered = level.isin("section", "part")
    return places | {
        "source": F.lit("ecfr"),
        "legal_status": F.lit("authoritative_unofficial"),
        "identifier": F.coalesce(identifier, F.concat(F.lit("/us/cfr/t"), n, F.lit("/s"), own)),
        "title": display,
        "title_number": title_number,
        "title_name": title_name,
        "positive_law": F.lit(False),
        "currency": currency,
        "last_updated": currency,
        "section_number": F.when(numbered, own),
        "section_name": F.when(numbered, name),
        "part_number": part_number,
        "cfr_part": part_number,
        "part_name": F.coalesce(places["part_name"], F.when(is_part, name)),
        "authority": F.nullif(authority, F.lit("")),
        "regulatory_source": F.nullif(regulatory_source, F.lit("")),
        "source_credit": F.nullif(source_credit, F.lit("")),
        "status": F.nullif(status, F.lit("")),
    }


def register_fields(document: Mapping[str, Column], sidecar: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Of a register document; fields of the JSON sidecar come before those of the markup.

    ``document``: document_number, subject, publication_date, document_type, agency, sub_agency, cfr, rin.  ``sidecar``:
    document_number, title, publication_date, document_type, agencies (array), cfr_references (array of 'T CFR Part P'), docket_ids (array),
    citation, volume, rin, effective_on, comments_close_on, action; any of them may be null.
    """
    extra = lambda name: (sidecar or {}).get(name, F.lit(None))
    own = lambda name: document.get(name, F.lit(None))
    first = lambda a, b: F.coalesce(extra(a).cast("string"), own(b).cast("string"), F.lit(""))
    some = lambda c: F.when(F.size(c) > 0, c)
    strings = "array<string>"
    number, subject, date = first("document_number", "document_number"), first("title", "subject"), first("publication_date", "publication_date")
    agencies = F.coalesce(some(extra("agencies").cast(strings)), some(F.array_compact(F.array(own("agency").cast("string"), F.when(own("agency").isNotNull(), own("sub_agency").cast("string"))))))
    none = F.lit("")
    return {
        "source": F.lit("fr"),
        "legal_status": F.lit("authoritative_unofficial"),
        "identifier": F.concat(F.lit("/us/fr/"), number),
        "title": subject,
        "title_number": F.lit(0),
        "title_name": F.lit("Federal Register"),
        "section_number": number,
        "section_name": subject,
        "positive_law": F.lit(False),
        "currency": date,
        "last_updated": date,
        "agency": F.get(agencies, 0),
        "document_number": F.nullif(number, none),
        "document_type": F.nullif(first("document_type", "document_type"), none),
        "fr_citation": extra("citation").cast("string"),
        "fr_volume": extra("volume").cast("long"),
        "publication_date": F.nullif(date, none),
        "agencies": agencies,
        "cfr_references": F.coalesce(some(extra("cfr_references").cast(strings)), F.when(F.coalesce(own("cfr").cast("string"), none) != "", F.array(own("cfr").cast("string")))),
        "docket_ids": some(extra("docket_ids").cast(strings)),
        "rin": F.nullif(first("rin", "rin"), none),
        "effective_date": extra("effective_on").cast("string"),
        "comments_close_date": extra("comments_close_on").cast("string"),
        "fr_action": extra("action").cast("string"),
    }


#: What the metadata of a document has for every source, and besides for each.
SHARED = [
    "identifier", "source", "legal_status", "display_title", "title_number", "title_name", "section_number", "section_name",
    "chapter_number", "chapter_name", "subchapter_number", "subchapter_name", "part_number", "part_name",
    "positive_law", "status", "currency", "last_updated",
]
OWN = {
    "usc": ["source_credit"],
    "ecfr": ["authority", "regulatory_source", "agency", "cfr_part", "cfr_subpart"],
    "fr": ["document_number", "document_type", "publication_date", "agency", "agencies", "fr_citation", "fr_volume", "effective_date", "comments_close_date", "fr_action", "docket_ids", "cfr_references"],
}
JSON_LISTS = {"agencies", "docket_ids", "cfr_references"}


def source_metadata(columns: list[str], source: str = "source") -> Column:
    """JSON of the metadata of a row: the shared fields and those of its source, null ones left out.

    Fields that the table lacks are null.  Lists are stored as JSON texts; malformed ones are null.  positive_law is stored as 0 or 1.
    """
    have = {c.lower() for c in columns}

    def value(name: str) -> Column:
        if name not in have:
            return F.lit(None).cast("string").alias(name)
        if name == "positive_law":
            return (F.col(name) == 1).alias(name)
        return (json_array(F.col(name)) if name in JSON_LISTS else F.col(name)).alias(name)

    out = F.to_json(F.struct(*map(value, SHARED)))
    for kind, extra in OWN.items():
        out = F.when(F.col(source) == kind, F.to_json(F.struct(*map(value, SHARED + extra)))).otherwise(out)
    return out


#: First path segments of resource names and the source that each stands for.
RESOURCES = {"us/usc/": "usc", "us/cfr/": "ecfr", "us/fr/": "fr"}


def parse_resource(uri: Column, scheme: str) -> Column:
    """Struct of source and identifier of '<scheme>://us/usc/t5/s1' and the like; both null for all other texts.

    Register documents go by their bare number, which must not be empty.
    """
    path = F.when(uri.startswith(f"{scheme}://"), F.substring(uri, len(scheme) + 4, 2**31 - 1))
    source, identifier = F.lit(None).cast("string"), F.lit(None).cast("string")
    for prefix, name in RESOURCES.items():
        if name == "fr":
            rest = F.nullif(F.regexp_replace(path, "^us/fr/", ""), F.lit(""))
            source = F.when(path.startswith(prefix) & rest.isNotNull(), name).otherwise(source)
            identifier = F.when(path.startswith(prefix), rest).otherwise(identifier)
        else:
            source = F.when(path.startswith(prefix), name).otherwise(source)
            identifier = F.when(path.startswith(prefix), F.concat(F.lit("/"), path)).otherwise(identifier)
    return F.struct(source.alias("source"), identifier.alias("identifier"))


def next_link(base: str, params: Mapping[str, str | int | None], has_more: Column, limit: int, offset: Column, cursor: Column | None = None) -> Column:
    """The link to the page after this one; null if there is none.

    Given parameters stay in their order, but for offset and cursor; limit is set.  A keyset listing goes on from
    ``cursor`` (no link where it is null), others from offset + limit.
    """
    kept = {k: v for k, v in params.items() if v is not None and k not in ("offset", "cursor")}
    head = f"{base}?{urlencode(kept | {'limit': limit})}"
    if cursor is not None:
        tail = F.concat(F.lit("&cursor="), F.url_encode(cursor))
    else:
        tail = F.concat(F.lit("&offset="), (offset + limit).cast("string"))
    return F.when(has_more, F.concat(F.lit(head), tail))
