"""Header-row delimited files: untyped, typed, single, whitelisted or by folder."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.constants import NULL_TOKENS
from recordloom.functions.records import folder_name_of, logical_file_of, source_type_of
from recordloom.functions.text import tokens_to_null
from recordloom.operators.numbering import numbered_by_split, with_scan_position

LINEAGE = ["source_file", "source_type", "source_dir", "row_number"]

# --- fixed values: what a numeric cell looks like ---
INTEGER_CELL = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_CELL = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI]nf(inity)?)\s*$"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``path``, ``file_name``, ``length`` of the matching files. Contents are not read.

    The parts of a table written by Spark as a folder ``<name>.csv`` carry that name.
    """
    reader = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True)
    own = folder.rstrip("/").rsplit("/", 1)[-1]
    steps = F.split("path", "/")
    directly = F.url_decode(F.element_at(steps, -2)) == own
    as_part = F.element_at(steps, -2).endswith(".csv") & (F.url_decode(F.element_at(steps, -3)) == own)
    listing = reader.load(folder).filter(directly | as_part)
    return listing.select("path", logical_file_of(F.col("path")).alias("file_name"), "length")


# --- fixed value: a line of the format in which every quoted field is closed ---
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",][^,]*+|)'
CLOSED_LINE = rf"^{_FIELD}(?:,{_FIELD})*+$"


def spanning_files(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """The files in which some quoted field holds a line break.

    Such a field is open at the end of its first line. A quote inside an unquoted
    field opens nothing.
    """
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    open_lines = lines.filter((quotes % 2 == 1) & ~F.col("value").rlike(CLOSED_LINE))
    return {r["path"] for r in open_lines.select("path").distinct().collect()}


def _table_path(path: str) -> str:
    """What a file is part of: itself, or the folder ``<name>.csv`` it lies in."""
    plain = unquote(re.sub("^file:/*", "/", path)).rstrip("/")
    parent = plain.rsplit("/", 1)[0]
    return parent if parent.endswith(".csv") else plain


def read_untyped(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool | None = None, numbered: bool = True
) -> DataFrame:
    """All cells as text, with file lineage and the 1-based row number per file.

    ``multi_line=None`` looks for line breaks inside quotes first: files without
    them, the usual case, are split freely between tasks; only the others are read
    one file per task.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if multi_line is None:
        spanning = {_table_path(p) for p in spanning_files(spark, paths)}
        whole = [p for p in paths if _table_path(p) in spanning]
        split = [p for p in paths if _table_path(p) not in spanning]
        parts = [_read(spark, some, way, numbered) for some, way in ((split, False), (whole, True)) if some]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _read(spark, paths, multi_line, numbered)


def _read(spark: SparkSession, paths: list[str], multi_line: bool, numbered: bool) -> DataFrame:
    scan = spark.read.options(header=True, escape='"', multiLine=multi_line).csv(paths)
    cells = scan.columns
    if not cells:
        raise ValueError(f"no header in {paths[0]}")
    positioned = with_scan_position(scan).withColumn("source_file", logical_file_of(F.col("_path")))
    if numbered:
        # Every split belongs to one task, and tasks are packed from whole splits.
        most_splits = len(scan.inputFiles()) + scan.rdd.getNumPartitions()
        positioned = numbered_by_split(positioned, "source_file", most_splits)
    else:
        positioned = positioned.withColumn("row_number", F.lit(None).cast("long")).drop("_block", "_position")
    inside = F.expr("left(_path, locate(concat('/', source_file), _path) - 1)")
    return positioned.select(
        *[F.col(f"`{c}`") for c in cells],
        "source_file",
        source_type_of(F.col("source_file")).alias("source_type"),
        folder_name_of(F.concat(inside, F.lit("/"))).alias("source_dir"),
        "row_number",
    )


def inferred_types(cells: DataFrame, columns: Sequence[str], tokens: Sequence[str] = NULL_TOKENS) -> dict[str, str]:
    """Column types found from all values: ``bigint``, ``double`` or ``string``.

    One aggregate over the whole input. Whole numbers with a missing cell become
    ``double``, dates and anything else stay ``string``. Only the counts, three per
    column, reach the driver.
    """
    checks = []
    for i, c in enumerate(columns):
        cell = tokens_to_null(F.col(f"`{c}`"), tokens)
        whole = cell.rlike(INTEGER_CELL) & F.trim(cell).try_cast("bigint").isNotNull()
        checks += [
            F.count_if(cell.isNull()).alias(f"missing_{i}"),
            F.count_if(cell.isNotNull() & ~whole).alias(f"not_whole_{i}"),
            F.count_if(cell.isNotNull() & ~cell.rlike(NUMBER_CELL)).alias(f"not_number_{i}"),
            F.count(F.lit(1)).alias(f"rows_{i}"),
        ]
    found = cells.agg(*checks).first()
    types = {}
    for i, c in enumerate(columns):
        if found[f"not_number_{i}"] or not found[f"rows_{i}"]:
            types[c] = "string"
        elif found[f"not_whole_{i}"] or found[f"missing_{i}"]:
            types[c] = "double"
        else:
            types[c] = "bigint"
    return types


def typed_cell(cell: Column, type_name: str) -> Column:
    cell = tokens_to_null(cell)
    return cell if type_name == "string" else F.trim(cell).try_cast(type_name)


def read_typed(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Typed cells with missing-value tokens as null, plus lineage and row numbers.

    Pass ``schema`` to skip the inference pass on large inputs.
    """
    raw = read_untyped(spark, paths, multi_line)
    cells = [c for c in raw.columns if c not in LINEAGE]
    if schema is not None:
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
    else:
        types = inferred_types(raw, cells)
    return raw.select(
        *[typed_cell(F.col(f"`{c}`"), types.get(c, "string")).alias(c) for c in cells], *LINEAGE
    )


def read_folder(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    typed: bool = True,
    schemas: Mapping[str, T.StructType] | None = None,
    multi_line: bool | None = None,
    errors: dict[str, str] | None = None,
    entity_pattern: str | None = None,
) -> dict[str, DataFrame]:
    """One DataFrame per file of the folder, keyed by entity type (the file stem), in name order.

    Files of one stem and different endings are keyed by their whole names. Entities
    differ in schema, so each is its own scan; the driver only sees the file list. Many
    files of one entity, told by ``entity_pattern`` as in ``folder_files``, are one scan.
    ``schemas`` by stem and ``multi_line`` spare lookups over large files. A file that
    cannot be read ends the call, or is listed in ``errors`` (name → message) if given.
    """
    files = folder_files(list_files(spark, folder, pattern), entity_pattern)
    return read_files(spark, files, typed, schemas, multi_line, errors)


def read_whitelist(
    spark: SparkSession, folder: str, wanted: Sequence[str], typed: bool = False
) -> tuple[dict[str, DataFrame], list[str]]:
    """Only the named files of a folder, and the names that are missing there."""
    listing = list_files(spark, folder, "*").filter(F.col("file_name").isin(list(wanted)))
    files = folder_files(listing)
    found = {name for name, _ in files.values()}
    return read_files(spark, files, typed), [w for w in wanted if w not in found]


def folder_files(listing: DataFrame, entity_pattern: str | None = None) -> dict[str, tuple[str, list[str]]]:
    """Key → (file name, paths of its parts), in name order.

    Files whose whole names match ``entity_pattern`` are one entity under its first group
    and share a header; they are read by one scan and keep their own names and row numbers.
    """
    paths: dict[str, list[str]] = {}
    entities: dict[str, tuple[str, list[str]]] = {}
    for name, path in sorted((r["file_name"], r["path"]) for r in listing.select("file_name", "path").collect()):
        if entity_pattern and (match := re.fullmatch(entity_pattern, name)):
            entities.setdefault(match[1], (name, []))[1].append(path)
        else:
            paths.setdefault(name, []).append(path)
    stems = Counter(name.rsplit(".", 1)[0] for name in paths)
    return entities | {
        stem if stems[stem] == 1 and stem not in entities else name: (name, found)
        for name, found in paths.items()
        for stem in [name.rsplit(".", 1)[0]]
    }


def read_files(
    spark: SparkSession,
    files: dict[str, tuple[str, list[str]]],
    typed: bool,
    schemas: Mapping[str, T.StructType] | None = None,
    multi_line: bool | None = None,
    errors: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """A table for each of ``folder_files``; see ``read_folder``."""

    def read(key: str) -> DataFrame | None:
        name, paths = files[key]
        try:
            if typed:
                return read_typed(spark, paths, (schemas or {}).get(key), multi_line)
            return read_untyped(spark, paths, multi_line)
        except Exception as error:  # noqa: BLE001 - whatever is wrong with this file, the others go on
            if errors is None:
                raise
            errors[name] = f"{type(error).__name__}: {error}".split("\n", 1)[0][:500]
            return None

    # Header and type lookups are small jobs of their own per entity; run them side by side.
    with ThreadPoolExecutor(max_workers=8) as pool:
        tables = dict(zip(files, pool.map(read, files)))
    return {key: table for key, table in tables.items() if table is not None}


def preview(table: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows of a numbered table, by row number rather than by whichever task answers first."""
    return table.filter(F.col("row_number") <= rows)
