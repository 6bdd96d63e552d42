"""Delimited files, numbering, envelopes and incremental ingestion."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from recordloom.operators import records as O
from recordloom.operators.describing import describe, template_describer
from recordloom.operators.records import build_records
from recordloom.plans import processing
from recordloom.sinks import envelopes as E
from recordloom.sources import delimited as D
from recordloom.sources.columnar import read_table
from recordloom.streaming.incremental import ingest, ingested


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture()
def folder(tmp_path):
    write_csv(tmp_path / "Pumps.csv", ["ID", "Name", "Power", "Qty", "Installed", "Spare"], [
        ["P-1", 'Gasket 4" 150#, large', "7.5", "1", "2022-03-15", ""],
        ["P-2", "1,800 kW – big", "11", "2", "2020-09-10", "3"],
        ["P/3", "-", "45.0", "3", "2021-01-18", "N/A"],
    ])
    write_csv(tmp_path / "Places.csv", ["FL_ID", "FL_Name"], [[f"F{i}", f"Place {i}"] for i in range(12)])
    return tmp_path


def test_untyped_scan_keeps_text(spark, folder):
    rows = D.read_untyped(spark, str(folder / "Pumps.csv")).orderBy("row_number").collect()
    assert [r["Name"] for r in rows] == ['Gasket 4" 150#, large', "1,800 kW – big", "-"]
    assert [r["Power"] for r in rows] == ["7.5", "11", "45.0"]
    assert [(r["source_file"], r["source_type"], r["row_number"]) for r in rows] == [("Pumps.csv", "Pumps", i) for i in (1, 2, 3)]
    assert {r["source_dir"] for r in rows} == {folder.name}


def test_typed_scan_infers_like_the_values(spark, folder):
    rows = D.read_typed(spark, str(folder / "Pumps.csv"))
    types = dict(rows.dtypes)
    assert (types["ID"], types["Power"], types["Qty"], types["Installed"], types["Spare"]) == ("string", "double", "bigint", "string", "double")
    assert [r["Spare"] for r in rows.orderBy("row_number").collect()] == [None, 3.0, None]
    texts = build_records(rows).orderBy("row_number").collect()
    assert texts[1]["combined_text"].endswith("| ID: P-2 | Name: 1,800 kW – big | Power: 11.0 | Qty: 2 | Installed: 2020-09-10 | Spare: 3.0")
    assert texts[0]["json_data"]["Spare"] is None and "Spare" in texts[0]["json_data"]


def test_numeric_look_alikes_stay_text(spark, tmp_path):
    cells = ["1d", "0x1p3", "1_000", "12 3"]
    write_csv(tmp_path / "t.csv", [f"c{i}" for i in range(4)] + ["exp", "big"], [[*cells, "1e5", "9223372036854775808"]])
    types = dict(D.read_typed(spark, str(tmp_path / "t.csv")).dtypes)
    assert [types[f"c{i}"] for i in range(4)] == ["string"] * 4
    assert types["exp"] == "double" and types["big"] == "double"


def test_row_numbers_across_splits(spark, tmp_path):
    write_csv(tmp_path / "long.csv", ["n", "pad"], [[i, "x" * (i % 37)] for i in range(1, 20001)])
    write_csv(tmp_path / "other.csv", ["n", "pad"], [[i, "y"] for i in range(1, 5001)])
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = D.read_untyped(spark, [str(tmp_path / "long.csv"), str(tmp_path / "other.csv")])
        assert rows.rdd.getNumPartitions() > 8
        wrong = rows.filter(F.col("row_number") != F.col("n").cast("bigint")).count()
        assert wrong == 0 and rows.count() == 25000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_line_breaks_in_quotes(spark, tmp_path):
    write_csv(tmp_path / "q.csv", ["a", "b"], [["one\ntwo", 'say "hi"'], ["x", "y"]])
    rows = D.read_untyped(spark, str(tmp_path / "q.csv")).orderBy("row_number").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("one\ntwo", 'say "hi"'), ("x", "y")]


def test_folder_whitelist_and_preview(spark, folder):
    (folder / "notes.txt").write_text("not a table")
    tables = D.read_folder(spark, str(folder))
    assert list(tables) == ["Places", "Pumps"]
    assert [r["FL_ID"] for r in D.preview(tables["Places"]).orderBy("row_number").collect()] == ["F0", "F1", "F2", "F3", "F4"]
    found, missing = D.read_whitelist(spark, str(folder), ["Pumps.csv", "Gone.csv"])
    assert list(found) == ["Pumps"] and missing == ["Gone.csv"]
    with pytest.raises(FileNotFoundError):
        processing.process_folder(spark, str(folder), "*.tsv")


def test_header_collision_is_refused(spark, folder):
    rows = D.read_typed(spark, str(folder / "Places.csv"))
    with pytest.raises(ValueError, match="collide"):
        O.rename_headers(rows, {"FL_ID": "x", "FL_Name": "x"})
    assert "Name" in O.rename_headers(rows, {"FL_Name": "Name", "absent": "y"}).columns


def test_folder_run_and_envelopes(spark, folder, tmp_path):
    run = processing.process_folder(spark, str(folder), batch_size=5)
    totals = run.totals.first()
    assert (totals["total_files"], totals["total_rows"], totals["processed_rows"], totals["total_calls"]) == (2, 15, 15, 4)
    out = str(tmp_path / "out")
    E.write_envelopes(E.envelopes(run.outcomes, 5, rows_per_envelope=5), out)
    back = E.read_processed(spark, out)
    assert back.count() == 15
    a = {(r["source_type"], r["row_number"], r["combined_text"]) for r in back.collect()}
    b = {(r["source_type"], r["row_number"], r["combined_text"]) for r in run.outcomes.collect()}
    assert a == b
    metadata = spark.read.schema(E.ENVELOPE + ",processed string").json(out).select("processed", "metadata").distinct()
    assert {(r["processed"], r["metadata"]["total_records"]) for r in metadata.collect()} == {
        ("Places_processed.json", 12),
        ("Pumps_processed.json", 3),
    }
    E.write_summary(run.file_results, run.totals, str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary" / "statistics")).first()["total_files"] == 2
    assert spark.read.json(str(tmp_path / "summary" / "files")).count() == 2


def test_reading_indented_single_file_envelopes(spark, tmp_path):
    record = {"row_number": 1, "json_data": {"a": 1950.0, "b": None, "c": "x"}, "semantic_statement": "s", "combined_text": "s | a: 1950.0"}
    for name, content in (
        ("Things_processed.json", {"metadata": {"total_records": 1}, "records": [record]}),
        ("processing_summary.json", {"statistics": {}, "files": []}),
        ("Empty_processed.json", {"metadata": {}}),
    ):
        (tmp_path / name).write_text(json.dumps(content, indent=2))
    rows = E.read_processed(spark, str(tmp_path), multi_line=True).collect()
    assert len(rows) == 1
    assert (rows[0]["source_type"], rows[0]["json_data"]) == ("Things", {"a": "1950.0", "b": None, "c": "x"})


def test_auto_run(spark, folder):
    results = processing.process_auto(spark, str(folder)).file_results.collect()
    assert {(r["source_file"], r["calls"]) for r in results} == {("Pumps.csv", 3), ("Places.csv", 12)}


def test_second_ingest_adds_only_new_files(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    write_csv(inbox / "A.csv", ["k", "v"], [[i, f"v{i}"] for i in range(50)])

    def build(batch):
        return build_records(batch).withColumn("status", F.when(F.element_at("json_data", "v") == "v7", "failed").otherwise("ok"))

    def run():
        ingest(spark, str(inbox), spark.read.csv(str(inbox), header=True).schema, build, out, state)
        return ingested(spark, out).count(), ingested(spark, out, "failed").count()

    assert run() == (49, 1)
    assert run() == (49, 1)
    write_csv(inbox / "B.csv", ["k", "v"], [[i, f"w{i}"] for i in range(10)])
    assert run() == (59, 1)
    numbers = ingested(spark, out).filter("source_file = 'B.csv'").select("row_number").collect()
    assert sorted(r[0] for r in numbers) == list(range(1, 11))


def test_resume_keeps_every_row_once(spark, folder):
    rows = build_records(D.read_typed(spark, str(folder / "Places.csv")))
    done = rows.filter("row_number <= 5")
    assert O.resumed(rows, 5, done).count() == 12
    assert O.remaining(rows, done).count() == 7


def test_describer_sees_rows_of_the_template(spark, folder):
    rows = build_records(D.read_typed(spark, str(folder / "Pumps.csv")))
    said = describe(rows.drop("semantic_statement", "combined_text"), template_describer, 2)
    assert {r["semantic_statement"] for r in said.collect()} == {r["semantic_statement"] for r in rows.collect()}


def test_latest_output_folder(spark, tmp_path):
    assert E.latest_output(spark, str(tmp_path)) is None
    for name in ("OUTPUT_20250101_000000", "OUTPUT_20250301_000000", "elsewhere"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "A_processed.json").write_text("{}")
    assert E.latest_output(spark, str(tmp_path)) == f"{tmp_path}/OUTPUT_20250301_000000"


def test_quotes_inside_plain_fields_do_not_span_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,4" pipe\n2,"6"" pipe"\n3,x\n')
    (tmp_path / "b.csv").write_text('k,v\n1,"two\nlines"\n2,y\n')
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    assert [p.rsplit("/", 1)[-1] for p in D.spanning_files(spark, paths)] == ["b.csv"]
    got = {(r["source_file"], r["row_number"]): r["v"] for r in D.read_untyped(spark, paths).collect()}
    assert got == {
        ("a.csv", 1): '4" pipe',
        ("a.csv", 2): '6" pipe',
        ("a.csv", 3): "x",
        ("b.csv", 1): "two\nlines",
        ("b.csv", 2): "y",
    }


def test_other_endings_and_bad_files(spark, folder):
    (folder / "Pumps.txt").write_text("k,v\n1,a\n2,b\n")
    (folder / "Broken.csv").write_text("\n")
    run = processing.process_auto(spark, str(folder), "*.txt")
    assert {(r["source_file"], r["calls"]) for r in run.file_results.collect()} == {("Pumps.txt", 2)}
    results = {r["source_file"]: r for r in processing.process_folder(spark, str(folder), "*").file_results.collect()}
    assert set(results) == {"Pumps.csv", "Pumps.txt", "Places.csv", "Broken.csv"}
    assert not results["Broken.csv"]["success"] and "header" in results["Broken.csv"]["error_message"]
    assert results["Pumps.csv"]["success"] and results["Pumps.txt"]["total_rows"] == 2


def test_ingested_files_read_like_batch_ones(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "A.csv").write_text('k,v\n1,"two\nlines"\n2,N/A\n3,z\n')
    ingest(spark, str(inbox), None, lambda t: t.withColumn("status", F.lit("ok")), str(tmp_path / "out"), str(tmp_path / "state"))
    columns = ["k", "v", "source_file", "row_number"]
    got = sorted(map(tuple, ingested(spark, str(tmp_path / "out")).select(columns).collect()))
    assert got == sorted(map(tuple, D.read_typed(spark, str(inbox / "A.csv")).select(columns).collect()))
    assert got == [(1, "two\nlines", "A.csv", 1), (2, None, "A.csv", 2), (3, "z", "A.csv", 3)]


def test_files_of_one_entity_are_read_together(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for part in range(3):
        write_csv(inbox / f"pump-{part}.csv", ["k", "v"], [[10 * part + i, "x\ny" if part == 1 else f"v{i}"] for i in range(4)])
    write_csv(inbox / "pump.csv", ["other"], [["z"]])
    files = D.folder_files(D.list_files(spark, str(inbox)), r"(\w+)-\d+\.csv")
    assert {key: len(paths) for key, (_, paths) in files.items()} == {"pump": 3, "pump.csv": 1}
    calls = []

    def build(table):
        calls.append(table.columns[0])
        return table.withColumn("status", F.lit("ok"))

    out = str(tmp_path / "out")
    ingest(spark, str(inbox), None, build, out, str(tmp_path / "state"), entity_pattern=r"(\w+)-\d+\.csv")
    rows = ingested(spark, out).filter("k is not null").collect()
    assert sorted(calls) == ["k", "other"]
    assert sorted((r.source_file, r.row_number, r.k) for r in rows) == [
        (f"pump-{p}.csv", i + 1, 10 * p + i) for p in range(3) for i in range(4)
    ]


def test_parts_of_a_parquet_folder_count_on(spark, tmp_path):
    from recordloom.catalog import QUERIES

    turns = [(c, t, ("system", "user", "assistant")[t], f"turn {c}.{t}") for c in range(15) for t in range(3)]
    for k in range(3):
        part = spark.createDataFrame(turns[15 * k : 15 * k + 15], "conv_id long, turn int, role string, text string")
        part.coalesce(1).write.parquet(f"{tmp_path}/written/{k}")
        (tmp_path / "conversations.parquet").mkdir(exist_ok=True)
        (found,) = (tmp_path / "written" / str(k)).glob("part-*.parquet")
        (tmp_path / "conversations.parquet" / f"part-{k}.parquet").write_bytes(found.read_bytes())
    rows = read_table(spark, f"{tmp_path}/conversations.parquet", "conversations").orderBy("conv_id", "turn").collect()
    assert [r["row_number"] for r in rows] == list(range(1, 46))
    assert {r["source_file"] for r in rows} == {"conversations.parquet"}
    # A batch that goes on in the next file is one batch, and no position is taken twice.
    answered = QUERIES["parse_responses"](spark, str(tmp_path)).collect()
    places = sorted((r["batch_id"], r["position"]) for r in answered)
    assert places == [(n // 8, n % 8 + 1) for n, t in enumerate(turns) if t[2] != "assistant"]


def test_mapping_is_written_compressed(spark, monkeypatch):
    from recordloom.catalog import QUERIES

    folders, write = [], E.write_json
    monkeypatch.setattr(E, "write_json", lambda rows, folder, *a, **k: (folders.append(folder), write(rows, folder, *a, **k)))
    assert QUERIES["mapping_json_roundtrip"](spark, "/root/testdata/sf0.001").count() > 0
    files = spark.read.format("binaryFile").load(folders).select("path").collect()
    assert files and all(r["path"].endswith(".json.gz") for r in files)
