"""What lies beside the documents of a title: metadata and overviews of chapters and titles, and chapters as one text.

A chapter's and a title's entries are one row of output each, as the files are; their texts and entries are put in order
inside that row and nowhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions.metadata import FORMAT_VERSION, GENERATOR
from registra.operators.markdown import heading

SECTION = ["identifier", "number", "name", "file", "token_estimate", "has_notes", "status"]
CHAPTER = ["title_number", "chapter_identifier", "chapter_number", "chapter_name", "directory"]


def _in_order(order: str, value: Column) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))), lambda e: e["v"])


def chapter_entries(sections: DataFrame, order: str = "ord") -> DataFrame:
    """(CHAPTER columns, first, sections, section_count, tokens) of every chapter; sections outside of chapters are in none.

    ``sections`` has CHAPTER and SECTION columns and their place in the title.
    """
    inside = sections.where(F.col("chapter_identifier").isNotNull())
    entry = F.struct(*SECTION)
    return inside.groupBy(*CHAPTER).agg(F.min(order).alias("first"), _in_order(order, entry).alias("sections"), F.count("*").alias("section_count"), F.sum("token_estimate").alias("tokens"))


def chapter_meta(chapters: DataFrame) -> DataFrame:
    """(title_number, directory, json): the metadata file of each chapter."""
    body = F.struct(
        F.lit(FORMAT_VERSION).alias("format_version"), F.col("chapter_identifier").alias("identifier"), "chapter_number", "chapter_name", "title_number", "section_count", "sections",
    )
    return chapters.select("title_number", "directory", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def title_meta(sections: DataFrame, chapters: DataFrame, titles: DataFrame, granularity: str = "section") -> DataFrame:
    """(title_number, json, readme): the metadata file and the overview of each title.

    ``titles`` has title_number, identifier, title_name, positive_law, currency, release_point, source_xml and generated_at.
    """
    sums = sections.groupBy("title_number").agg(F.count("*").alias("section_count"), F.sum("token_estimate").alias("total_tokens_estimate"))
    entry = F.struct(F.col("chapter_identifier").alias("identifier"), F.col("chapter_number").alias("number"), F.col("chapter_name").alias("name"), "directory", "sections")
    listed = chapters.groupBy("title_number").agg(_in_order("first", entry).alias("chapters"), F.count("*").alias("chapter_count"))
    rows = titles.join(sums, "title_number").join(listed, "title_number", "left")
    rows = rows.withColumn("chapter_count", F.coalesce("chapter_count", F.lit(0).cast("long")))
    stats = F.struct("chapter_count", "section_count", F.col("section_count").alias("total_files"), "total_tokens_estimate")
    body = F.struct(
        F.lit(FORMAT_VERSION).alias("format_version"), F.lit(GENERATOR).alias("generator"), "generated_at", "identifier", "title_number", "title_name", "positive_law",
        "currency", "release_point", "source_xml", F.lit(granularity).alias("granularity"), stats.alias("stats"), F.coalesce("chapters", F.array()).alias("chapters"),
    )
    return rows.select("title_number", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"), _overview(granularity).alias("readme"))


def part_entries(sections: DataFrame, order: str = "ord") -> DataFrame:
    """(title_number, number, first, identifier, name, directory, sections, section_count, chars) of every part of the regulations.

    ``sections`` has title_number, part_identifier, part_number, part_name, content_length, the SECTION columns but for
    token_estimate, and their place in the title.  A part's identifier and name are those of its first section; a missing
    identifier is made of the numbers.  Sections without a part are in one with the number ''.
    """
    tokens = F.ceil(F.col("content_length") / 4).alias("token_estimate")
    entry = F.struct(*[tokens if c == "token_estimate" else F.col(c) for c in SECTION])
    rows = sections.withColumn("_part", F.coalesce("part_number", F.lit("")))
    grouped = rows.groupBy("title_number", F.col("_part").alias("number")).agg(
        F.min(order).alias("first"), F.min_by("part_identifier", order).alias("found"), F.min_by("part_name", order).alias("name"),
        _in_order(order, entry).alias("sections"), F.count("*").alias("section_count"), F.sum("content_length").alias("chars"),
    )
    made = F.concat(F.lit("/us/cfr/t"), F.col("title_number").cast("string"), F.lit("/pt"), "number")
    identifier = F.coalesce(F.nullif(F.col("found"), F.lit("")), made)
    return grouped.withColumn("identifier", identifier).withColumn("directory", F.concat(F.lit("part-"), "number")).drop("found")


def part_meta(parts: DataFrame) -> DataFrame:
    """(title_number, directory, json): the metadata file of each part of the regulations."""
    body = F.struct(
        F.lit(FORMAT_VERSION).alias("format_version"), "identifier", F.col("number").alias("part_number"), F.col("name").alias("part_name"), "title_number", "section_count", "sections",
    )
    return parts.select("title_number", "directory", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def regulation_title_meta(parts: DataFrame, titles: DataFrame, granularity: str = "section") -> DataFrame:
    """(title_number, json, readme): the metadata file and the overview of each title of the regulations.

    ``titles`` has title_number, title_name, currency, source_xml and generated_at; a title without sections has no parts.
    """
    entry = F.struct("identifier", "number", "name", "directory", "sections")
    sums = parts.groupBy("title_number").agg(
        F.count("*").alias("part_count"), F.sum("section_count").alias("section_count"), F.ceil(F.sum("chars") / 4).alias("total_tokens_estimate"), _in_order("first", entry).alias("parts"),
    )
    rows = titles.join(sums, "title_number", "left").withColumn("parts", F.coalesce("parts", F.array()))
    for c in ("part_count", "section_count", "total_tokens_estimate"):
        rows = rows.withColumn(c, F.coalesce(c, F.lit(0).cast("long")))
    number = F.col("title_number").cast("string")
    stats = F.struct("part_count", "section_count", F.col("section_count").alias("total_files"), "total_tokens_estimate")
    body = F.struct(
        F.lit(FORMAT_VERSION).alias("format_version"), F.lit(GENERATOR).alias("generator"), "generated_at", F.concat(F.lit("/us/cfr/t"), number).alias("identifier"), "title_number", "title_name",
        F.lit("ecfr").alias("source"), F.lit("authoritative_unofficial").alias("legal_status"), "currency", "source_xml", F.lit(granularity).alias("granularity"), stats.alias("stats"), "parts",
    )
    facts = [("Source", F.lit("eCFR (govinfo.gov)")), ("Legal Status", F.lit("Authoritative, unofficial"))]
    facts += [(n, F.format_number(c, 0)) for n, c in (("Parts", "part_count"), ("Sections", "section_count"), ("Estimated Tokens", "total_tokens_estimate"))]
    facts.append(("Granularity", F.lit(granularity)))
    table = [F.concat(F.lit(f"| {name} | "), value, F.lit(" |")) for name, value in facts]
    part = lambda p: F.concat(F.lit("### Part "), p["number"], F.lit(" — "), F.coalesce(p["name"], F.lit("")), F.lit(" ("), F.size(p["sections"]).cast("string"), F.lit(" sections)\n"))
    head = F.concat(F.lit("# Title "), number, F.lit(" — "), F.col("title_name"), F.lit("\n"))
    readme = F.concat_ws("\n", head, F.lit("| Metric | Value |\n|--------|-------|"), *table, F.lit("\n## Parts\n"), F.transform("parts", part), F.lit(f"---\n\nGenerated by {GENERATOR}\n"))
    return rows.select("title_number", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"), readme.alias("readme"))


def _overview(granularity: str) -> Column:
    text = lambda c: F.col(c).cast("string")
    facts = [
        ("Positive Law", F.when(F.col("positive_law"), "Yes").otherwise("No")),
        ("Currency", F.coalesce(F.nullif(F.col("currency"), F.lit("")), F.lit("unknown"))),
        ("Chapters", text("chapter_count")),
        ("Sections", F.format_number("section_count", 0)),
        ("Est. Tokens", F.format_number("total_tokens_estimate", 0)),
        ("Granularity", F.lit(granularity)),
    ]
    table = [F.concat(F.lit(f"| **{name}** | "), value, F.lit(" |")) for name, value in facts]

    def part(c: Column) -> Column:
        n = F.size(c["sections"])
        head = F.concat(F.lit("### Chapter "), c["number"].cast("string"), F.lit(" — "), c["name"])
        return F.concat(head, F.lit("\n\n"), n.cast("string"), F.when(n == 1, " section").otherwise(" sections"), F.lit(" · ["), c["directory"], F.lit("/]("), c["directory"], F.lit("/)\n"))

    listed = F.transform(F.coalesce("chapters", F.array()), part)
    head = F.concat(F.lit("# Title "), text("title_number"), F.lit(" — "), F.col("title_name"))
    return F.concat_ws("\n", F.concat(head, F.lit("\n")), F.lit("| | |\n| --- | --- |"), *table, F.lit("\n## Chapters\n"), listed, F.lit(f"---\n\nGenerated by {GENERATOR}\n"))


def chapter_texts(sections: DataFrame, order: str = "ord") -> DataFrame:
    """(CHAPTER columns, markdown): each chapter as one text, its sections in order under headings of the second level.

    ``sections`` has CHAPTER columns, number, name and markdown; sections outside of chapters are in none.
    """
    own = F.concat(heading(F.lit(2), F.concat(F.lit("§ "), "number", F.lit(". "), "name")), F.lit("\n\n"), F.col("markdown"))
    grouped = sections.where(F.col("chapter_identifier").isNotNull()).groupBy(*CHAPTER).agg(F.array_join(_in_order(order, own), "\n\n").alias("body"))
    head = heading(F.lit(1), F.concat(F.lit("Chapter "), F.col("chapter_number").cast("string"), F.lit(" — "), F.col("chapter_name")))
    return grouped.select(*CHAPTER, F.concat(head, F.lit("\n\n"), F.col("body")).alias("markdown"))
