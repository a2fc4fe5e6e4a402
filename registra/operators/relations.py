"""Joins and windows of the data model: links, inheritance, ancestors, enrichment, change detection, carry-forward."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.functions import identifiers


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key in ``order``; one row a key crosses the shuffle from each task."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def resolved_links(refs: DataFrame, href: str, registry: DataFrame, source_file: str, order: Column | None = None) -> DataFrame:
    """``refs`` with target_file, link (relative path) and url.

    A reference leads to the file of its identifier, else to that of the section it lies in; ``url`` is the
    link, else the publisher's page.  ``registry`` has identifier and file_path; of several rows with one identifier the
    last in ``order`` counts (by default the greatest path), so that a reference stays one row.
    """
    registry = last_wins(registry.select("identifier", "file_path", *([] if order is None else [order.alias("_order")])), ["identifier"], [F.desc("file_path" if order is None else "_order"), F.desc("file_path")])
    exact = registry.select(F.col("identifier").alias("_exact"), F.col("file_path").alias("_exact_file"))
    section = registry.select(F.col("identifier").alias("_section"), F.col("file_path").alias("_section_file"))
    out = refs.join(exact, refs[href] == F.col("_exact"), "left").join(section, identifiers.section_identifier(F.col(href)) == F.col("_section"), "left")
    target = F.coalesce("_exact_file", "_section_file")
    out = out.withColumn("target_file", target).drop("_exact", "_exact_file", "_section", "_section_file")
    out = out.withColumn("link", identifiers.relative_path(F.col(source_file), F.col("target_file")))
    return out.withColumn("url", F.coalesce(F.col("link"), identifiers.fallback_url(F.col(href))))


def inherited(children: DataFrame, parents: DataFrame, key: str, fields: Mapping[str, str]) -> DataFrame:
    """``children`` whose null fields take their parent's: ``fields`` maps a child's column to the parent's."""
    above = parents.select(F.col(key).alias("_key"), *[F.col(p).alias(f"_from_{c}") for c, p in fields.items()])
    out = children.join(above, children[key] == above["_key"], "left")
    for c in fields:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_from_{c}")))
    return out.drop("_key", *[f"_from_{c}" for c in fields])


def nearest_ancestor(ancestors: Column, level: str, outermost: bool = True) -> Column:
    """The first ancestor of a level in an array of structs from the root down."""
    found = F.filter(ancestors, lambda a: a["level_type"] == level)
    return F.get(found, 0) if outermost else F.get(found, F.size(found) - 1)


def enriched(rows: DataFrame, sidecar: DataFrame, key: str, fields: Sequence[str], force: bool = False) -> DataFrame:
    """``rows`` with the sidecar's fields and an outcome: enriched, already or not_found.

    Rows that have all fields stay unless ``force``; otherwise the sidecar wins where it has a value.
    """
    side = sidecar.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_new_{f}") for f in fields])
    out = rows.join(side, rows[key] == side["_key"], "left")
    done = F.lit(True)
    for f in fields:
        done = done & F.col(f).isNotNull()
    outcome = F.when(done & F.lit(not force), "already").when(F.col("_key").isNull(), "not_found").otherwise("enriched")
    out = out.withColumn("outcome", outcome)
    for f in fields:
        out = out.withColumn(f, F.when(F.col("outcome") == "enriched", F.coalesce(F.col(f"_new_{f}"), F.col(f))).otherwise(F.col(f)))
    return out.drop("_key", *[f"_new_{f}" for f in fields])


def changes(stored: DataFrame, found: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, outcome) for all keys of either side: new, updated, unchanged or pruned."""
    old = stored.select(F.col(key).alias("_old"), F.col(digest).alias("_old_digest"))
    new = found.select(F.col(key).alias("_new"), F.col(digest).alias("_new_digest"))
    both = old.join(new, F.col("_old") == F.col("_new"), "full")
    outcome = (
        F.when(F.col("_old").isNull(), "new")
        .when(F.col("_new").isNull(), "pruned")
        .when(F.col("_old_digest").eqNullSafe(F.col("_new_digest")), "unchanged")
        .otherwise("updated")
    )
    return both.select(F.coalesce("_new", "_old").alias(key), outcome.alias("outcome"))


def orphans(stored: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key is gone."""
    return stored.join(found.select(key).distinct(), key, "left_anti")


def changed_since(now: DataFrame, checkpoint: DataFrame, key: str, stamp: str) -> DataFrame:
    """Rows whose stamp is later than the checkpoint's or that have none there."""
    before = checkpoint.select(F.col(key).alias("_key"), F.col(stamp).alias("_before"))
    out = now.join(before, now[key] == before["_key"], "left")
    return out.where(F.col("_before").isNull() | (F.col(stamp) > F.col("_before"))).drop("_key", "_before")


def padded(df: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """``df`` and those of the expected rows whose key it lacks."""
    return df.unionByName(expected.join(df.select(key), key, "left_anti"), allowMissingColumns=True)


def duplicate_suffixes(df: DataFrame, parent: Sequence[str], number: str, order: Sequence[Column], out: str = "suffix") -> DataFrame:
    """'' for the first row of a number inside its parent, then -2, -3, ..."""
    n = F.row_number().over(Window.partitionBy(*parent, number).orderBy(*order))
    return df.withColumn("_n", n).withColumn(out, F.when(F.col("_n") > 1, F.concat(F.lit("-"), F.col("_n").cast("string"))).otherwise("")).drop("_n")


#: Topics of notes that decide their category whatever heading they stand under.
AMENDMENT_TOPICS = ["amendments", "effectiveDateOfAmendment", "shortTitleOfAmendment"]
EDITORIAL_TOPICS = ["codification", "dispositionOfSections"]
STATUTORY_TOPICS = ["changeOfName", "regulations", "miscellaneous", "repeals", "separability", "crossReferences"]


def carried(df: DataFrame, container: Sequence[str], order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """The last value that is not null in each container, up to and with each row."""
    w = Window.partitionBy(*container).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def notes_kept(notes: DataFrame, container: Sequence[str], order: Sequence[Column], editorial: bool, statutory: bool, amendments: bool) -> DataFrame:
    """Notes that pass the filter; columns role and topic.

    Cross-headings set the category of the notes after them.  A note's own topic goes before its category.
    """
    heading = F.col("role") == "crossHeading"
    category = F.when(heading & (F.col("topic") == "editorialNotes"), "editorial").when(heading & (F.col("topic") == "statutoryNotes"), "statutory")
    rows = carried(notes, container, order, category, "_category")
    any_ = F.lit(editorial or statutory or amendments)
    by_heading = F.when(F.col("_category") == "editorial", F.lit(editorial or amendments)).when(F.col("_category") == "statutory", F.lit(statutory or amendments))
    by_note = (
        F.when(F.col("topic").isin(AMENDMENT_TOPICS), F.lit(amendments))
        .when(F.col("topic").isin(EDITORIAL_TOPICS), F.lit(editorial))
        .when(F.col("topic").isin(STATUTORY_TOPICS), F.lit(statutory))
        .when(F.col("_category") == "editorial", F.lit(editorial))
        .when(F.col("_category") == "statutory", F.lit(statutory))
    )
    kept = F.when(heading, F.coalesce(by_heading, any_)).otherwise(F.coalesce(by_note, any_))
    return rows.where(F.coalesce(kept, any_)).drop("_category")


def upserted(stored: DataFrame, batch: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Stored rows replaced by the last row of their key in ``batch``; others stay, new ones are added."""
    last = last_wins(batch, [key], order)
    return stored.join(last.select(key), key, "left_anti").unionByName(last, allowMissingColumns=True)
