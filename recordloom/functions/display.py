"""What a search result shows of a record, by entity type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.constants import FIELD_SEPARATOR
from recordloom.functions.records import map_default

# --- fixed values: entity type → (label, key, shown only if present, unit) ---
DISPLAYED = {
    "Equipment": [
        ("Name", "Equipment_Name", False, ""),
        ("Manufacturer", "Manufacturer", False, ""),
        ("Model", "Model", False, ""),
        ("Power", "Nameplate_Power_kW", True, " kW"),
        ("Location", "FL_ID", True, ""),
    ],
    "Functional_Locations": [("Name", "FL_Name", False, ""), ("Site", "Site_Area", False, ""), ("Parent", "Parent_FL_ID", False, "")],
    "Equipment_Material": [
        ("Equipment", "Equipment_ID", False, ""),
        ("Material", "Material_ID", False, ""),
        ("Quantity", "Qty", False, ""),
        ("Notes", "Notes", False, ""),
    ],
}


def display_text(kind: Column, data: Column) -> Column:
    """``Label: value`` parts of the type's own fields; other types show nothing."""
    shown = None
    for name, fields in DISPLAYED.items():
        parts = []
        for label, key, optional, unit in fields:
            value = F.coalesce(map_default(data, key), F.lit("None"))
            part = F.concat(F.lit(f"{label}: "), value, F.lit(unit))
            parts.append(F.when(F.map_contains_key(data, key), part) if optional else part)
        text = F.concat_ws(FIELD_SEPARATOR, *parts)
        shown = F.when(kind == name, text) if shown is None else shown.when(kind == name, text)
    return shown.otherwise(F.lit(""))
