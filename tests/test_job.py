"""Resumable runs: the ledger, what a killed run leaves, and the outputs."""

from __future__ import annotations

import json
import pathlib
import shutil

import pytest
from pyspark.sql import functions as F

from recordloom.__main__ import main
from recordloom.operators import describing
from recordloom.operators.describing import template_describer
from recordloom.plans import job

PUMPS = "Equipment_ID,Name,Power\n" + "".join(f"EQ-{k},Pump {k},{k * 5}\n" for k in range(1, 48))
VENDORS = "Vendor_ID,Vendor_Name\nV-1,Alpha\nV-2,Beta\n"


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "Pumps.csv").write_text(PUMPS)
    (source / "Vendors.csv").write_text(VENDORS)
    return source


def refusing(*names):
    def describe(rows):
        if any(r.get("Name") in names for r in rows):
            raise ValueError("refused")
        return template_describer(rows)

    return describe


def statuses(done, name="Pumps.csv"):
    rows = done.outcomes.filter(F.col("source_file") == name).collect()
    assert len({r.row_number for r in rows}) == len(rows)
    return {r.row_number: (r.status, r.run) for r in rows}


def test_stopped_run_goes_on_where_it_ended(spark, folder, tmp_path):
    output = str(tmp_path / "out")
    settings = {"mode": "optimized", "batch_size": 5}
    first = job.process_to(spark, str(folder), output, describer=refusing("Pump 13"), on_error="stop", rows_per_commit=10, **settings)
    # Rows past the stretch that held the failure wait for the next call.
    assert first.runs == [0, 1] and set(statuses(first)) == set(range(1, 21))
    assert {k for k, (s, _) in statuses(first).items() if s == "ok"} == set(range(1, 11))
    assert {k for k, (s, _) in statuses(first).items() if s == "failed"} == set(range(11, 16))

    second = job.process_to(spark, str(folder), output, describer=template_describer, **settings)
    found = statuses(second)
    assert {k: r for k, (_, r) in found.items()} == {k: 0 if k <= 10 else 2 for k in range(1, 48)}
    assert {s for s, _ in found.values()} == {"ok"}
    assert statuses(second, "Vendors.csv") == {1: ("ok", 0), 2: ("ok", 0)}
    totals = second.totals.first()
    assert (totals.total_rows, totals.processed_rows, totals.failed_files) == (49, 49, 0)
    # Calls of both runs: two stretches and the batch that failed, then eight batches; one for the vendors.
    assert totals.total_calls == 2 + 1 + 8 + 1
    runs = {r.run: r for r in second.run_results.collect()}
    assert [(runs[k].rows, runs[k].processed_rows, runs[k].calls) for k in (0, 1, 2)] == [(12, 12, 3), (10, 0, 1), (37, 37, 8)]
    assert all(r.seconds > 0 and r.started for r in runs.values()) and runs[2].rows_per_second > 0
    assert totals.seconds == pytest.approx(sum(r.seconds for r in runs.values()))


def test_part_of_a_killed_run_does_not_count(spark, folder, tmp_path):
    output = tmp_path / "out"
    job.process_to(spark, str(folder / "Vendors.csv"), str(output), mode="simple")
    shutil.copytree(output / "outcomes" / "run=0", output / "outcomes" / "run=1")
    (output / "outcomes" / "run=1" / "_SUCCESS").unlink()
    assert job.committed_runs(spark, str(output)) == [0]
    assert job.ledger(spark, str(output)).count() == 2
    done = job.process_to(spark, str(folder), str(output), mode="optimized")
    assert done.runs == [0, 1] and done.outcomes.count() == 49
    # A run that was killed before it noted its time still counts.
    shutil.rmtree(output / "clock" / "run=0")
    again = job.read_job(spark, str(output))
    assert {r.run: r.seconds is None for r in again.run_results.collect()} == {0: True, 1: False}


def test_failed_rows_are_kept_or_tried_again(spark, folder, tmp_path):
    output = str(tmp_path / "out")
    settings = {"mode": "optimized", "batch_size": 10}
    done = job.process_to(spark, str(folder), output, describer=refusing("Pump 7", "Pump 30"), **settings)
    assert {k for k, (s, _) in statuses(done).items() if s == "failed"} == {7, 30}
    kept = job.process_to(spark, str(folder), output, describer=template_describer, retry_failed=False, **settings)
    assert {k for k, (s, _) in statuses(kept).items() if s == "failed"} == {7, 30}
    some = job.process_to(spark, str(folder), output, describer=refusing("Pump 30"), **settings)
    assert statuses(some)[7] == ("ok", 2) and statuses(some)[30] == ("failed", 2)
    listed = [json.loads(x) for f in pathlib.Path(output, "failed").glob("*.json") for x in f.read_text().splitlines()]
    assert [r["row_data"]["Name"] for r in listed] == ["Pump 30"]
    files = {r.source_file: r for r in spark.read.json(f"{output}/summary/files").collect()}
    assert (files["Pumps.csv"].processed_rows, files["Pumps.csv"].failed_rows) == (46, 1)
    assert (files["Pumps.csv"].mode, files["Pumps.csv"].batch_size) == ("optimized", 10)
    assert spark.read.json(f"{output}/summary/runs").count() == 3
    envelope = spark.read.json(f"{output}/processed").filter("processed = 'Pumps_processed.json'").first()
    assert (envelope.metadata.total_records, envelope.metadata.failed_records, envelope.metadata.batch_size) == (46, 1, 10)


def test_new_files_and_unreadable_ones(spark, folder, tmp_path):
    output = str(tmp_path / "out")
    job.process_to(spark, str(folder), output, output_mode="consolidated")
    (folder / "Sites.csv").write_text("FL_ID,FL_Name\nA,North\n")
    (folder / "Broken.csv").write_text("\n")
    done = job.process_to(spark, str(folder), output, output_mode="consolidated")
    results = {r.source_file: r for r in done.file_results.collect()}
    assert results["Sites.csv"].success and not results["Broken.csv"].success and results["Broken.csv"].error_message
    assert spark.read.parquet(f"{output}/consolidated").count() == 50
    with pytest.raises(FileNotFoundError):
        job.process_to(spark, str(folder), output, pattern="*.tsv")
    with pytest.raises(ValueError):
        job.process_to(spark, str(folder), output, mode="guess")
    with pytest.raises(FileNotFoundError):
        job.read_job(spark, str(tmp_path / "nothing"))


def test_headers_and_modes(spark, folder, tmp_path):
    done = job.process_to(spark, str(folder / "Pumps.csv"), str(tmp_path / "a"), header_mapping={"Name": "item"})
    assert dict(done.outcomes.filter("row_number = 3").first().json_data) == {"Equipment_ID": "EQ-3", "item": "Pump 3", "Power": "15"}
    assert done.totals.first().total_calls == 47  # a small file goes row by row
    done = job.process_to(spark, str(folder / "Pumps.csv"), str(tmp_path / "b"), mode="folder", batch_size=20)
    assert done.totals.first().total_calls == 3
    found = {r.source_type: r.suggestion for r in job.suggestion(spark, str(folder)).collect()}
    assert found["Pumps"].startswith("optimized (batch_size=5)") and found["Vendors"].startswith("simple")


def test_command_line(spark, folder, tmp_path, capsys):
    output, index = str(tmp_path / "out"), str(tmp_path / "index")
    main(["process", str(folder), output, "--mode", "optimized", "--batch-size", "10"])
    main(["analyze", str(folder)])
    main(["index", output, index])
    main(["search", index, "Pump 31", "--alpha", "0.7", "-k", "3"])
    shown = capsys.readouterr().out
    assert "Pumps.csv" in shown and "optimized (batch_size=5)" in shown and "EQ-" in shown


def test_a_commit_reads_its_own_rows_only(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("ID,Name\n" + "".join(f"{n},name {n}\n" for n in range(1, 26)))
    plans, process = [], job.process_table

    def watched(rows, *settings):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return process(rows, *settings)

    monkeypatch.setattr(job, "process_table", watched)
    done = job.process_to(spark, str(tmp_path / "in"), str(tmp_path / "out"), mode="optimized", batch_size=5, rows_per_commit=10)
    assert [(r["run"], r["row_number"]) for r in done.outcomes.orderBy("row_number").collect()] == [
        ((n - 1) // 10, n) for n in range(1, 26)
    ]
    assert len(plans) == 3
    assert all("csv" not in p and "PartitionFilters: [isnotnull(_commit" in p for p in plans)


def test_outputs_share_the_latest_outcomes(spark, folder, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(
        job.E, "write_json", lambda rows, *a, kept=job.E.write_json, **k: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or kept(rows, *a, **k)
    )
    done = job.process_to(spark, str(folder), str(tmp_path / "out"), mode="optimized", batch_size=5, describer=refusing("Pump 13"))
    # No output ranks the outcomes of all runs for itself.
    assert len(plans) == 4 and not any("Window" in p for p in plans)
    assert {k for k, (s, _) in statuses(done).items() if s == "failed"} == {13}
    listed = [json.loads(line) for f in (tmp_path / "out" / "failed").glob("*.json") for line in f.read_text().splitlines()]
    assert [(r["source_file"], r["row_number"]) for r in listed] == [("Pumps.csv", 13)]


def test_a_commit_describes_its_files_together(spark, folder, tmp_path, monkeypatch):
    asked, written = [], describing.written
    monkeypatch.setattr(describing, "written", lambda rows, purpose: asked.append(rows) or written(rows, purpose))
    settings = {"mode": "optimized", "batch_size": 5, "describer": template_describer, "on_error": "stop"}
    done = job.process_to(spark, str(folder), str(tmp_path / "out"), rows_per_commit=30, **settings)
    assert len(asked) == 2 and done.runs == [0, 1]
    assert statuses(done) == {k: ("ok", 0 if k <= 30 else 1) for k in range(1, 48)}
    assert statuses(done, "Vendors.csv") == {1: ("ok", 0), 2: ("ok", 0)}
    whole = job.process_to(spark, str(folder), str(tmp_path / "whole"), **settings)
    columns = [c for c in whole.outcomes.columns if c not in ("run", "json_data")]
    rows = [sorted(x.outcomes.select(*columns, F.to_json("json_data")).collect()) for x in (done, whole)]
    assert rows[0] == rows[1] and {r.seconds > 0 for r in done.run_results.collect()} == {True}
