"""Scalar functions against plain Python."""

import math
import random
import struct

from pyspark.sql import functions as F

from recordloom.functions import planning as P
from recordloom.functions import records as R
from recordloom.functions import scoring as C
from recordloom.functions import text as X


def test_float_text_is_python_str(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, -1.5, 1e7, 123456789.0, 1e15, 1e16, 1.5e16, 1e-3, 1e-4, 1.5e-4, -2.5e-4, 1e-5, 2.5e-7,
              1e22, 1e23, 2e-3, 1e100, 5e-324, 1.7976931348623157e308, 0.1 + 0.2, 1 / 3, 1e6 / 3, 9999999.999999998,
              float("inf"), float("-inf"), float("nan"), 1.00036210000000013e18, 12345678.9]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 20) for _ in range(2000)]
    values += [round(rng.uniform(0, 1e9), 2) for _ in range(1000)]
    values += [v for v in (struct.unpack("d", rng.randbytes(8))[0] for _ in range(1000)) if not math.isnan(v)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r["i"]: r["t"] for r in df.select("i", F.expr(X.float_text("v")).alias("t")).collect()}
    assert all(float(got[i]) == v or math.isnan(v) for i, v in enumerate(values))
    # Past 1e16 the digits come from the JVM, which before Java 19 is not always the shortest spelling.
    wrong = [(str(v), got[i]) for i, v in enumerate(values) if got[i] != str(v) and 1e-12 < abs(v) < 1e16]
    assert not wrong, wrong[:10]


def test_long_float_texts_are_not_formatted_thrice(spark):
    # Noise of products, a carry into the next power, negatives, all ranges of notation.
    values = [0.07 / 1000, -0.07 / 1000, 33078.94 * 1000, 84197.04 * 1000, 9.999999999999999e7, -1234567.8901234567, 0.30000000000000004,
              1.2345678901234567e-4, -1.2345678901234567e-5, 9007199254740994.0, -8.419704e15, 2.0**-44, 2.0**-10, 1e-9, 1e-10, 1e-100]
    assert "format_string" not in X.float_text("v")
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
    got = df.select("v", F.expr(X.float_text("v")).alias("t")).collect()
    assert len(got) == len(values) and [r["t"] for r in got] == [str(r["v"]) for r in got]


def test_integral_text(spark):
    df = spark.createDataFrame([(29.0,), (1.5,), (None,), (-3.0,)], "v double")
    assert [r[0] for r in df.select(F.expr(X.integral_text("v"))).collect()] == ["29", "1.5", None, "-3"]


def test_text_rules(spark):
    df = spark.createDataFrame([("x'y", None, "", "null", 7), (None, None, None, None, None)], "a string, `b c` string, d string, e string, f int")
    fields = X.field_texts(df)
    rows = df.select(
        X.structured_text(fields).alias("null"),
        X.structured_text(fields, "empty").alias("empty"),
        X.structured_text(fields, "none").alias("none"),
        X.template_statement(fields).alias("s"),
        X.json_text(X.json_map(fields)).alias("j"),
    ).collect()
    assert rows[0]["null"] == "a: x'y | d:  | e: null | f: 7"
    assert rows[0]["empty"] == "a: x'y | e: null | f: 7"
    assert rows[0]["none"] == "a: x'y | b c: None | d:  | e: null | f: 7"
    assert rows[0]["s"] == "Record with a is x'y, f is 7..."
    assert rows[0]["j"] == '{"a":"x\'y","b c":null,"d":"","e":"null","f":"7"}'
    assert rows[1]["s"] == "Record" and rows[1]["null"] == ""


def test_map_forms_agree_with_column_forms(spark):
    df = spark.createDataFrame([("1", None, "", "null"), ("a", "b", "c", "d")], "a string, b string, c string, d string")
    fields = X.field_texts(df)
    with_map = df.select("*", X.json_map(fields).alias("m"))
    rows = with_map.select(
        (X.structured_text(fields) == X.structured_text_of_map(F.col("m"))).alias("x"),
        (X.template_statement(fields) == X.template_statement_of_map("m")).alias("y"),
    ).collect()
    assert all(r["x"] and r["y"] for r in rows)


def test_record_id_depends_on_key_presence(spark):
    cases = [
        ({"Equipment_ID": "E1", "Material_ID": "M1"}, "E1"),
        ({"FL_ID": "F1"}, "F1"),
        ({"Material_ID": "M1"}, "unknown_M1"),
        ({"Equipment_ID": None, "FL_ID": "F"}, None),
        ({"x": "y"}, "row_4"),
    ]
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(cases)], "i bigint, m map<string,string>")
    got = df.orderBy("i").select(R.record_id(F.col("m"), R.row_label(F.col("i")))).collect()
    assert [r[0] for r in got] == [e for _, e in cases]


def test_default_is_for_absent_keys_only(spark):
    df = spark.createDataFrame([({"Criticality": None},), ({"a": "b"},), ({"Criticality": "H"},)], "m map<string,string>")
    assert [r[0] for r in df.select(R.map_default(F.col("m"), "Criticality")).collect()] == [None, "N/A", "H"]


def test_parameter_rules(spark):
    df = spark.createDataFrame([("0.7", "3"), ("", ""), ("9", "99"), ("-1", "0"), ("abc", "2.5"), (" 0.2 ", " 4 ")], "a string, k string")
    got = df.select(C.clamped_alpha(F.col("a")), C.clamped_k(F.col("k"))).collect()
    assert [tuple(r) for r in got] == [(0.7, 3), (0.5, 5), (1.0, 10), (0.0, 1), (0.5, 5), (0.2, 4)]
    labels = spark.createDataFrame([(0.61,), (0.6,), (0.4,), (0.39,)], "a double").select(C.alpha_label(F.col("a"))).collect()
    assert [r[0] for r in labels] == ["Semantic-focused", "Balanced", "Balanced", "Structured-focused"]


def test_batch_size_rules(spark):
    # rows, avg chars, density -> size: steps, small files, sparse and dense factors, bounds
    cases = [
        (1000, 100.0, 0.5, 20), (1000, 300.0, 0.5, 15), (1000, 900.0, 0.5, 10), (1000, 5000.0, 0.5, 5),
        (5, 100.0, 0.5, 5), (30, 100.0, 0.5, 10), (1000, 100.0, 0.2, 30), (1000, 100.0, 0.9, 16),
        (5, 100.0, 1.0, 4), (1, 100.0, 1.0, 1), (20, 169.8, 1.0, 8), (19, 168.8, 0.943, 8),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "r bigint, c double, d double")
    got = df.select(P.batch_size_by_tokens(F.col("r"), F.col("c"), F.col("d"))).collect()
    assert [r[0] for r in got] == [c[3] for c in cases]
    chars = spark.createDataFrame([(99.0,), (100.0,), (299.0,), (300.0,), (500.0,)], "c double")
    assert [r[0] for r in chars.select(P.batch_size_by_chars(F.col("c"))).collect()] == [20, 15, 15, 10, 5]


def test_modes(spark):
    df = spark.createDataFrame(
        [(False, True, 10, 9.0), (False, True, 50, 0.1), (False, True, 50, 1.0), (True, True, 0, 0.0),
         (False, False, 500, 5.0), (False, True, None, 5.0), (False, True, 150, 1.0), (False, True, 5000, 1.0)],
        "folder boolean, csv boolean, rows int, mb double",
    )
    mode = P.detected_mode(F.col("folder"), F.col("csv"), F.col("rows"), F.col("mb"))
    got = df.select(mode.alias("m"), P.detected_batch_size(mode, F.col("rows")).alias("b")).collect()
    assert [r["m"] for r in got] == ["simple", "simple", "optimized", "folder", "simple", "simple", "optimized", "optimized"]
    assert [r["b"] for r in got][-2:] == [15, 20]
