"""Identifiers, lineage and metadata of hybrid records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.constants import PROCESSED_SUFFIX


def map_default(data: Column, key: str, default: str = "N/A") -> Column:
    """The value under ``key``; the default stands in for an absent key, not for a null value."""
    return F.when(F.map_contains_key(data, key), F.element_at(data, key)).otherwise(F.lit(default))


def record_id(
    data: Column,
    otherwise: Column,
    whole_keys: Sequence[str] = ("Equipment_ID", "FL_ID"),
    part_key: str = "Material_ID",
    owner_key: str = "Equipment_ID",
    unknown_owner: str | None = "unknown",
) -> Column:
    """The identifier of a record, chosen by which keys it has.

    The first key of ``whole_keys`` that is present is the identifier. A record
    with only ``part_key`` is named ``owner_part``, or by the bare part when
    ``unknown_owner`` is None. Anything else gets ``otherwise``.
    """
    has = lambda key: F.map_contains_key(data, key)
    part = F.element_at(data, part_key)
    if unknown_owner is not None:
        part = F.concat(map_default(data, owner_key, unknown_owner), F.lit("_"), part)
    chosen = None
    for key in whole_keys:
        branch = (has(key), F.element_at(data, key))
        chosen = F.when(*branch) if chosen is None else chosen.when(*branch)
    chosen = F.when(has(part_key), part) if chosen is None else chosen.when(has(part_key), part)
    return chosen.otherwise(otherwise)


def row_label(row_number: Column) -> Column:
    return F.concat(F.lit("row_"), row_number.cast("string"))


def ordinal_label(ordinal: Column) -> Column:
    return F.concat(F.lit("record_"), ordinal.cast("string"))


def source_type_of(file_name: Column) -> Column:
    """Entity type of a file: its name without the processed-record or ``.csv`` ending."""
    return F.regexp_replace(file_name, r"(" + PROCESSED_SUFFIX.replace(".", r"\.") + r"|\.csv)$", "")


def file_name_of(path: Column) -> Column:
    return F.url_decode(F.element_at(F.split(path, "/"), -1))


def folder_name_of(path: Column) -> Column:
    return F.url_decode(F.element_at(F.split(path, "/"), -2))


def logical_file_of(path: Column, ending: str = ".csv") -> Column:
    """The name a table goes by: its file, or the folder ``<name>.csv`` whose part files make it up."""
    folder = folder_name_of(path)
    return F.when(folder.endswith(ending), folder).otherwise(file_name_of(path))


def id_kind(identifier: Column) -> Column:
    """Which set an identifier belongs to by its prefix; null when neither."""
    return F.when(identifier.startswith("MAT-"), F.lit("material")).when(
        identifier.startswith("V-"), F.lit("vendor")
    )
