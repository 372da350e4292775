"""JSON and XML access by rule-supplied paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: root element of the XML bodies.
XML_ROOT = "page"
_BREAK = "\u0001"


def json_text(document: Column, path: str | None) -> Column:
    """Value at a JSON path as text, empty when the path is blank or leads nowhere."""
    if not path or not path.strip():
        return F.lit("")
    return F.coalesce(F.get_json_object(document, path), F.lit(""))


def json_found(document: Column, paths: Sequence[str | None]) -> Column:
    """What stands at each JSON path, in path order; null for a blank path or a missing value."""
    return F.array(*[F.get_json_object(document, p) if p and p.strip() else F.lit(None).cast("string") for p in paths])


def as_list(found: Column) -> Column:
    """A found JSON value as a list of strings; null gives an empty list."""
    # A wildcard with a single match comes back as the bare JSON value.
    listed = F.when(found.startswith("["), found).otherwise(F.concat(F.lit("["), found, F.lit("]")))
    return F.coalesce(F.from_json(listed, "array<string>"), F.array().cast("array<string>"))


def with_xml_page(df: DataFrame, body: Column, into: str = "_page") -> DataFrame:
    """Add the body from its root element on, or null when that is not one well-formed document.

    Done in steps so that each body is cut and checked once.
    """
    start, end = f"<{XML_ROOT}>", f"</{XML_ROOT}>"
    cut = F.regexp_replace(F.substring(body, F.instr(body, start), F.length(body)), r"\s+\z", "")
    shaped, checked = f"{into}_shaped", f"{into}_checked"
    return (df.withColumn(shaped, F.when(body.contains(start), cut))
            .withColumn(shaped, F.when(F.col(shaped).endswith(end), F.col(shaped)))
            .withColumn(checked, F.from_xml(
                F.concat(F.lit("<r>"), F.col(shaped), F.lit("</r>")),
                f"{XML_ROOT} array<string>, _broken string",
                {"rowTag": "r", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
            .withColumn(into, F.when(F.col(checked)["_broken"].isNull() & (F.size(F.col(checked)[XML_ROOT]) == 1),
                                     F.col(shaped)))
            .drop(shaped, checked))


def xpath_text(page: Column, path: str | None) -> Column:
    """Text at an XPath; empty for a blank path, a missing node or a missing page."""
    if not path or not path.strip():
        return F.lit("")
    return F.coalesce(F.when(page.isNotNull(), F.xpath_string(page, F.lit(path))), F.lit(""))


def xpath_texts(page: Column, paths: Sequence[str | None]) -> Column:
    """Texts at several XPaths from one reading of the page, as a list in the order of the paths.

    The texts are joined by a character that no XML document may hold.
    """
    parts = [path if path and path.strip() else "''" for path in paths]
    joined = f"concat({f", '{_BREAK}', ".join([*parts, "''"])})"
    return F.split(F.when(page.isNotNull(), F.xpath_string(page, F.lit(joined))), _BREAK)


def xpath_list(page: Column, path: str | None) -> Column:
    """Values of all nodes at an XPath, empty list when there are none."""
    empty = F.array().cast("array<string>")
    if not path or not path.strip():
        return empty
    return F.coalesce(F.when(page.isNotNull(), F.xpath(page, F.lit(path))), empty)
