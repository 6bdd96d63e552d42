"""Turning typed columns into the texts of a hybrid record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.constants import FIELD_SEPARATOR, NULL_TOKENS


# {v} is the column, {s} its Spark text. Whole numbers are printed as such. Up to 17 characters of
# mantissa Spark's digits are the shortest ones already and are only moved around, and so are 17 digits that
# do not read back as the same number with fewer. What is left is rare; nested lambdas compute each step of
# rounding its mantissa as a decimal once. The first condition names the text twice, so that Spark computes it once per value.
_FLOAT_TEXT = """
CASE
  WHEN length({s}) + 100 * instr({s}, 'E') <= 17 AND abs({v}) < 1e7 THEN {s}
  WHEN {v} IS NULL THEN NULL
  WHEN isnan({v}) THEN 'nan'
  WHEN abs({v}) = double('Infinity') THEN if({v} > 0, 'inf', '-inf')
  WHEN abs({v}) >= 1e7 AND abs({v}) < 1e16 AND cast({v} AS bigint) = {v} THEN concat(cast(cast({v} AS bigint) AS string), '.0')
  WHEN abs({v}) >= 1e7 AND abs({v}) < 1e16 AND ({shortest}) THEN
    rtrim('0', cast(cast({v} AS decimal(38, 10)) AS string))
  WHEN abs({v}) >= 1e-4 AND abs({v}) < 1e-3 AND ({shortest}) THEN
    concat(if({v} < 0, '-', ''), '0.000', rtrim('0', translate(substring_index({s}, 'E', 1), '-.', '')))
  WHEN (abs({v}) < 1e-4 OR abs({v}) >= 1e16) AND ({shortest}) THEN concat(
    if(instr({s}, '.0E') > 0, substring_index({s}, '.', 1), substring_index({s}, 'E', 1)),
    if(abs({v}) < 1, if(abs({v}) >= 1e-9, 'e-0', 'e-'), 'e+'),
    ltrim('-', substring_index({s}, 'E', -1)))
  ELSE transform(transform(transform(transform(
    array(cast(abs({v}) AS string)),
    a -> struct(a AS text, ltrim('0', translate(substring_index(a, 'E', 1), '.', '')) AS digits)),
    d -> struct(
      cast(concat(substring(d.digits, 1, 1), '.', substring(d.digits, 2)) AS decimal(18, 17)) AS mantissa,
      CASE
        WHEN instr(d.text, 'E') > 0 THEN cast(substring_index(d.text, 'E', -1) AS int)
        WHEN abs({v}) >= 1 THEN instr(d.text, '.') - 2
        ELSE length(d.digits) - length(d.text) + 1 END AS power)),
    m -> struct(
      rtrim('0', translate(cast(CASE
        WHEN cast(concat(cast(round(m.mantissa, 14) AS string), 'E', cast(m.power AS string)) AS double) = abs({v})
          THEN round(m.mantissa, 14)
        WHEN cast(concat(cast(round(m.mantissa, 15) AS string), 'E', cast(m.power AS string)) AS double) = abs({v})
          THEN round(m.mantissa, 15)
        ELSE round(m.mantissa, 16) END AS string), '.', '')) AS digits,
      m.power AS power)),
    p -> concat(
      if({v} < 0, '-', ''),
      CASE
        WHEN p.power BETWEEN 0 AND 15 THEN concat(
          rpad(substring(p.digits, 1, p.power + 1), p.power + 1, '0'), '.',
          if(length(p.digits) > p.power + 1, substring(p.digits, p.power + 2, 40), '0'))
        WHEN p.power BETWEEN -4 AND -1 THEN concat('0.', repeat('0', -p.power - 1), p.digits)
        ELSE concat(
          substring(p.digits, 1, 1),
          if(length(p.digits) > 1, concat('.', substring(p.digits, 2, 40)), ''),
          if(p.power < 0, 'e-', 'e+'),
          lpad(cast(abs(p.power) AS string), if(abs(p.power) > 99, 3, 2), '0')) END))[0]
END"""


_READS_BACK = (
    "cast(concat(cast(round(cast(substring_index({s}, 'E', 1) AS decimal(18, 17)), {places}) AS string), "
    "substring({s}, instr({s}, 'E'))) AS double) = {v}"
)
_SHORTEST = (
    "instr({s}, 'E') BETWEEN 1 AND 18 OR instr({s}, 'E') = if({v} < 0, 20, 19) "
    f"AND NOT ({_READS_BACK.replace('{places}', '14')} OR {_READS_BACK.replace('{places}', '15')})"
)


def quoted(text: str) -> str:
    """A Python string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def float_text(name: str) -> str:
    """SQL for a double column as its shortest decimal text: plain from 1e-4 up to 1e16, else ``1e+16`` style.

    Spark's own cast already gives that between 1e-3 and 1e7 with up to 16 digits;
    only other values take the longer branches. Beyond 1e16 the last digit is the
    JVM's choice among spellings that read back as the same number.
    """
    value = column_sql(name)
    names = {"v": value, "s": f"cast({value} AS string)"}
    return _FLOAT_TEXT.format(**names, shortest=_SHORTEST.format(**names))


def value_text(name: str, data_type: T.DataType) -> str:
    """SQL for the text form of a column's cells, null staying null."""
    value = column_sql(name)
    if isinstance(data_type, T.DoubleType):
        return float_text(name)
    if isinstance(data_type, T.BooleanType):
        return f"initcap(cast({value} AS string))"
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return f"to_json({value})"
    return value if isinstance(data_type, T.StringType) else f"cast({value} AS string)"


def field_texts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """``{column name: SQL of its text}`` in header order.

    The text builders below take such mappings and parse one SQL expression each,
    which keeps building records of wide tables fast.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(columns) if columns is not None else list(types)
    return {name: value_text(name, types[name]) for name in names}


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def tokens_to_null(value: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~value.isin(list(tokens)), value)


def integral_text(name: str) -> str:
    """SQL for a double column's text, values without a fraction losing their ``.0``."""
    value = column_sql(name)
    return (
        f"CASE WHEN {value} = floor({value}) AND abs({value}) < 9.0e18 "
        f"THEN cast(cast({value} AS bigint) AS string) ELSE {float_text(name)} END"
    )


def structured_text(fields: Mapping[str, str], skip: str = "null") -> Column:
    """``k: v`` pairs joined by the field separator.

    ``skip`` names the values left out: ``"null"``, ``"empty"`` (null or blank
    text) or ``"none"`` (nothing; a null prints as ``None``).
    """
    kept = {"null": "{t}", "empty": "nullif({t}, '')", "none": "coalesce({t}, 'None')"}
    if skip not in kept:
        raise ValueError(f"unknown skip rule {skip!r}")
    pairs = [f"concat({quoted(name + ': ')}, {kept[skip].format(t=text)})" for name, text in fields.items()]
    return F.expr(f"concat_ws({', '.join([quoted(FIELD_SEPARATOR), *pairs])})")


def structured_text_of_map(data: Column) -> Column:
    """The same text from a ``map<string,string>``, for records read back from storage."""
    present = F.filter(F.map_entries(data), lambda e: e["value"].isNotNull())
    return F.array_join(F.transform(present, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), FIELD_SEPARATOR)


def combined_text(statement: Column, structured: Column) -> Column:
    return F.concat(statement, F.lit(FIELD_SEPARATOR), structured)


_SENTENCE = (
    "if(size(p) > 0, concat('Record with ', array_join(slice(p, 1, {shown}), ', '), '...'), 'Record')"
)


def template_statement(fields: Mapping[str, str], shown: int = 3) -> Column:
    """``Record with a is 1, b is 2, c is 3...`` over the first usable fields, else ``Record``."""
    phrases = ", ".join(
        f"if({text} NOT IN ('', 'null'), concat({quoted(name + ' is ')}, {text}), NULL)" for name, text in fields.items()
    )
    return F.expr(f"transform(array(array_compact(array({phrases}))), p -> {_SENTENCE.format(shown=shown)})[0]")


def template_statement_of_map(data: str, shown: int = 3) -> Column:
    """The same statement from a ``map<string,string>`` column."""
    usable = f"filter(map_entries({column_sql(data)}), e -> e.value NOT IN ('', 'null'))"
    phrases = f"transform({usable}, e -> concat(e.key, ' is ', e.value))"
    return F.expr(f"transform(array({phrases}), p -> {_SENTENCE.format(shown=shown)})[0]")


def fallback_statement(stem: Column, row_number: Column) -> Column:
    return F.concat(F.lit("Data for "), stem, F.lit(" row "), row_number.cast("string"))


def error_statement(message: Column) -> Column:
    return F.concat(F.lit("Error: "), message)


def shortened(text: Column, length: int = 100) -> Column:
    """The display form: a leading part and an ellipsis, added even to short texts."""
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def json_map(fields: Mapping[str, str]) -> Column:
    """``map<string,string>`` in header order, keeping nulls and so key presence."""
    keys = ", ".join(quoted(n) for n in fields)
    return F.expr(f"map_from_arrays(array({keys}), array({', '.join(fields.values())}))")


def json_text(data: Column) -> Column:
    return F.to_json(data, {"ignoreNullFields": "false"})
