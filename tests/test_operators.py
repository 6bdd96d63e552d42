"""Describer policies, skew handling, search and mapping against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators import describing as D
from recordloom.operators import mapping as M
from recordloom.operators import numbering as N
from recordloom.operators import profiling as G
from recordloom.operators import records as O
from recordloom.operators import resolving as R
from recordloom.operators import searching as S
from recordloom.operators import summarizing as Z
from recordloom.operators.embedding import embedded, hashing_encoder
from recordloom.operators.records import build_records
from recordloom.operators.resolving import containing_texts, resolve_names
from recordloom.operators.skew import nested_lists
from recordloom.plans.entity_map import map_equipment
from recordloom.plans.search_index import build_index, query_table, search


def records(spark, sizes):
    rows = [(f"{f}.csv", f, n, {"v": str(n)}) for f, size in sizes.items() for n in range(1, size + 1)]
    return spark.createDataFrame(rows, "source_file string, source_type string, row_number bigint, json_data map<string,string>")


def refusing(*bad):
    def call(rows):
        if any(int(r["v"]) in bad for r in rows):
            raise RuntimeError("refused")
        return [f"row {r['v']}" for r in rows]

    return call


# ------------------------------------------------------------------- describer


@pytest.mark.parametrize("policy", D.POLICIES)
def test_every_row_has_exactly_one_outcome(spark, policy):
    rows = records(spark, {"A": 23, "B": 7})
    out = D.describe(rows, refusing(6, 15), 5, policy)
    assert out.count() == 30 and out.select("source_file", "row_number").distinct().count() == 30


def test_policies(spark):
    rows = records(spark, {"A": 12})
    status = lambda policy: [
        r["status"] for r in D.describe(rows, refusing(6), 4, policy).orderBy("row_number").collect()
    ]
    assert status("split") == ["ok"] * 5 + ["failed"] + ["ok"] * 6
    assert status("drop") == ["ok"] * 4 + ["failed"] * 4 + ["ok"] * 4
    assert status("stop") == ["ok"] * 4 + ["failed"] * 4 + ["pending"] * 4
    assert status("fallback") == ["ok"] * 4 + ["fallback"] * 4 + ["ok"] * 4
    assert status("error_record") == ["ok"] * 5 + ["error_record"] + ["ok"] * 6
    shown = {r["row_number"]: r for r in D.describe(rows, refusing(6), 4, "fallback").collect()}
    assert shown[5]["semantic_statement"] == "Data for A row 5" and shown[5]["combined_text"] == "v: 5"
    erred = {r["row_number"]: r for r in D.describe(rows, refusing(6), 4, "error_record").collect()}
    assert erred[6]["semantic_statement"] == "Error: refused" and erred[6]["combined_text"] == '{"v":"6"}'


def test_short_and_blank_answers_fail(spark):
    rows = records(spark, {"A": 4})
    short = D.describe(rows, lambda r: ["x"] * (len(r) - 1) if len(r) > 1 else ["x"], 4, "drop")
    assert {r["error_message"] for r in short.collect()} == {"3 results for 4 rows"}
    blank = D.describe(rows, lambda r: [""] * len(r), 2, "split")
    assert {r["status"] for r in blank.collect()} == {"failed"}


def test_calls_and_retries_are_counted(spark):
    out = D.describe(records(spark, {"A": 4}), refusing(3), 4, "split", attempts=2)
    got = {r["row_number"]: (r["retry_count"], r["calls"]) for r in out.collect()}
    # whole batch twice, left half once, right half twice, its rows once and twice
    assert sum(c for _, c in got.values()) == 2 + 1 + 2 + 2 + 1
    assert got[3][0] == 6


def test_retry_recovers_and_conserves(spark):
    dropped = D.describe(records(spark, {"A": 10}), refusing(6), 5, "drop")
    again = D.retried(dropped, refusing(6))
    assert again.count() == 10 and again.filter("status = 'failed'").count() == 1
    assert D.failures(again).first()["row_data"] == {"v": "6"} and again.filter("status = 'ok'").count() == 9


def test_outcomes_do_not_depend_on_partitions(spark):
    rows = records(spark, {"A": 50, "B": 33})
    one = {tuple(r) for r in D.describe(rows.coalesce(1), refusing(8, 40), 7, "drop").select("source_file", "row_number", "status").collect()}
    many = {tuple(r) for r in D.describe(rows.repartition(13), refusing(8, 40), 7, "drop").select("source_file", "row_number", "status").collect()}
    assert one == many


def test_rows_reach_the_describer_without_their_old_texts(spark):
    old = {c: F.concat(F.lit("old "), "row_number") for c in ("semantic_statement", "combined_text")}
    rows = records(spark, {"A": 4}).withColumns(old)
    out = D.describe(rows, refusing(3), 2, "split")
    assert [r["combined_text"] for r in out.orderBy("row_number").collect()] == ["row 1 | v: 1", "row 2 | v: 2", None, "row 4 | v: 4"]
    (sent,) = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in line]
    assert "combined_text" not in sent and "semantic_statement" not in sent and "json_data" in sent
    assert [c for c in out.columns if c in rows.columns] == rows.columns


def test_many_short_names_take_one_pass(spark):
    rng = np.random.default_rng(4)
    texts = [(i, None if i % 9 == 0 else "".join(rng.choice(list("abA \u00e9\U0001f600"), rng.integers(0, 70)))) for i in range(60)]
    names = [("".join(rng.choice(list("abA \u00e9"), rng.integers(0, 5))),) for _ in range(40)] + [(None,), ("A" * 50,)]
    names += [(t[k : k + 20],) for k, (_, t) in enumerate(texts[:40]) if t]
    names, texts_of = spark.createDataFrame(names, "n string"), spark.createDataFrame(texts, "i int, t string").repartition(3)
    found = containing_texts(names, "n", texts_of, "t", "i", block_chars=40)
    # However many the names, short ones go through the texts once.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    wanted = {r["n"].lower() for r in names.collect() if r["n"]}
    got = [tuple(r) for r in found.collect()]
    assert sorted(got) == sorted((n, i) for n in wanted for i, t in texts if t and n in t.lower())


def test_text_maps_become_dictionaries():
    held = [[("a", "1"), ("b", None)], None, [], [("a", "x")], [("b", "\u00e9"), ("c", "")]]
    maps = pa.array(held * 3, pa.map_(pa.string(), pa.string()))
    want = [dict(m or []) for m in held * 3]
    assert D._dicts(maps) == want and D._dicts(maps.slice(3, 7)) == want[3:10] and D._dicts(maps.slice(0, 0)) == []


def test_prompts_and_responses(spark):
    rows = records(spark, {"A": 3})
    prompts = {r["batch_id"]: r["prompt"] for r in D.batch_prompts(rows, 2, "H", "T").collect()}
    assert prompts == {0: 'H\n--- Row 1 ---\n{"v":"1"}\n--- Row 2 ---\n{"v":"2"}T', 1: 'H\n--- Row 1 ---\n{"v":"3"}T'}
    replies = spark.createDataFrame(
        [("A.csv", 0, '{"row_1": {"description": "one"}, "row_2": {"description": ""}}'), ("A.csv", 1, "{}")],
        "source_file string, batch_id bigint, response string",
    )
    joined = D.attach_descriptions(rows, D.parse_responses(replies), 2)
    assert [r["status"] for r in joined.orderBy("row_number").collect()] == ["ok", "failed", "failed"]
    assert {r["batch_id"]: r["complete"] for r in D.batch_completeness(joined).collect()} == {0: False, 1: False}


def test_progress(spark):
    out = D.describe(records(spark, {"A": 10, "B": 4}), refusing(6), 4, "drop")
    got = {(r["source_file"], r["batch_id"]): (r["processed_so_far"], r["percent"]) for r in Z.progress(out).collect()}
    # row 6 of A is refused; B has only four rows
    assert got[("A.csv", 1)] == (4, 40.0) and got[("A.csv", 2)] == (6, 60.0) and got[("B.csv", 0)] == (4, 100.0)


# ----------------------------------------------------------------- windows and skew


def test_running_total_with_small_blocks(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    got = N.running_total(df, "v", "o", ["g"], "total", block_rows=10)
    expected, sums = {}, [0, 0, 0]
    for i in range(1000):
        sums[i % 3] += i % 7
        expected[i] = sums[i % 3]
    assert {r["o"]: r["total"] for r in got.collect()} == expected


def test_nested_lists_chunk_only_large_keys(spark):
    rows = spark.range(0, 1010).select(F.when(F.col("id") < 1000, "big").otherwise("small").alias("k"), "id")
    lists = nested_lists(rows, ["k"], F.col("id"), "ids", F.col("id"), max_items=100).collect()
    big = [r["ids"] for r in lists if r["k"] == "big"]
    assert len(big) == 10 and max(map(len, big)) < 200 and sorted(i for b in big for i in b) == list(range(1000))
    assert [r["ids"] for r in lists if r["k"] == "small"] == [list(range(1000, 1010))]


def test_nested_lists_with_everyone(spark):
    rows = spark.range(0, 1000).select(F.when(F.col("id") < 990, "big").otherwise("stray").alias("k"), "id")
    everyone = spark.createDataFrame([("big", "B"), ("none", "N")], "k string, title string")
    for bound in (100, 10_000):
        got = nested_lists(rows, ["k"], F.col("id"), "ids", F.col("id"), max_items=bound, everyone=everyone).collect()
        assert {(r["k"], r["title"]) for r in got} == {("big", "B"), ("none", "N")}
        assert sorted(i for r in got for i in r["ids"]) == list(range(990))
        assert len(got) == (1 + 10 if bound == 100 else 2)
    loose = nested_lists(rows, ["k"], F.col("id"), "ids", F.col("id"), everyone=everyone, only_listed=False).collect()
    assert {(r["k"], r["title"], len(r["ids"])) for r in loose} == {("big", "B", 990), ("none", "N", 0), ("stray", None, 10)}


# -------------------------------------------------------------------------- search


def vectors(spark, n, dims, seed, extra=0):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(n, dims)), rng.normal(size=(n, dims))
    if extra:
        a[-extra:], b[-extra:] = a[:extra], b[:extra]
    a, b = a.astype("float32"), b.astype("float32")
    rows = [(i, a[i].tolist(), b[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "rec_id bigint, sem_vec array<float>, str_vec array<float>")
    return df, a.astype("float64"), b.astype("float64")


def brute(corpus, query, k):
    d = np.round(((corpus - query) ** 2).sum(axis=1), 10)
    order = sorted(range(len(d)), key=lambda i: (d[i], i))[:k]
    return [(i, d[i]) for i in order]


@pytest.mark.parametrize("parts,block", [(1, 4096), (7, 4096), (7, 5)])
def test_nearest_is_exact(spark, parts, block):
    corpus, a, b = vectors(spark, 300, 16, 1, extra=40)
    asked, qa, qb = vectors(spark, 20, 16, 2)
    queries = asked.withColumnRenamed("rec_id", "query_id").withColumn("alpha", F.lit(0.3))
    found = S.nearest(corpus.repartition(parts), queries, 7, max_block=block).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault((r["query_id"], r["stream"]), []).append((r["rec_id"], r["distance"]))
        at = {"semantic": (a, qa), "structured": (b, qb)}
        for stream, (c, q) in at.items():
            want = np.round(((c[r["rec_id"]] - q[r["query_id"]]) ** 2).sum(), 10)
            assert abs(r[f"{stream}_distance"] - want) < 1e-9
    for q in range(20):
        for stream, c, m in (("semantic", a, qa), ("structured", b, qb)):
            want = brute(c, m[q], 7)
            assert [i for i, _ in got[(q, stream)]] == [i for i, _ in want]


def test_fusion_kinds(spark):
    corpus, a, b = vectors(spark, 50, 8, 3)
    asked, qa, qb = vectors(spark, 3, 8, 4)
    queries = asked.withColumnRenamed("rec_id", "query_id").withColumn("alpha", F.lit(0.25))
    by_rank = S.hybrid_search(corpus, queries, 5, "rank").collect()
    by_id = S.hybrid_search(corpus, queries, 5, "id").collect()
    for q in range(3):
        sem, struct = brute(a, qa[q], 5), brute(b, qb[q], 5)
        hits = sorted((r for r in by_rank if r["query_id"] == q), key=lambda r: r["rank"])
        assert [h["rec_id"] for h in hits] == [i for i, _ in sem]
        for h, (_, d), (_, e) in zip(hits, sem, struct):
            assert abs(h["combined_score"] - (0.25 / (1 + d) + 0.75 / (1 + e))) < 1e-9
        ids = {i for i, _ in sem} | {i for i, _ in struct}
        score = {i: 0.25 / (1 + ((a[i] - qa[q]) ** 2).sum()) + 0.75 / (1 + ((b[i] - qb[q]) ** 2).sum()) for i in ids}
        want = sorted(ids, key=lambda i: -score[i])[:5]
        assert [h["rec_id"] for h in sorted((r for r in by_id if r["query_id"] == q), key=lambda r: r["rank"])] == want


def test_small_corpus_and_no_queries(spark):
    corpus, _, _ = vectors(spark, 3, 4, 5)
    asked, _, _ = vectors(spark, 2, 4, 6)
    queries = asked.withColumnRenamed("rec_id", "query_id").withColumn("alpha", F.lit(0.5))
    assert S.hybrid_search(corpus, queries, 10).count() == 6
    assert S.hybrid_search(corpus, queries.filter("query_id < 0"), 10).count() == 0


def test_first_seen_closes_ranks(spark):
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, "c"), (2, 1, "b")], "query_id int, rank int, key string")
    got = {(r["query_id"], r["rank"], r["key"]) for r in S.first_seen(hits, "key", 2).collect()}
    assert got == {(1, 1, "a"), (1, 2, "b"), (2, 1, "b")}


def test_encoder_is_reproducible_and_whole_text(spark):
    long = "word " * 30000 + "tail"
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, long), (5, "word " * 30000)], "i int, t string")
    column = embedded(F.col("t"), hashing_encoder(16), 2)
    first = {r["i"]: r["v"] for r in df.select("i", column.alias("v")).collect()}
    second = {r["i"]: r["v"] for r in df.repartition(5).select("i", column.alias("v")).collect()}
    assert first == second
    assert sum(first[2]) == 0 and sum(first[3]) == 0 and abs(sum(x * x for x in first[1]) - 1) < 1e-6
    assert first[4] != first[5]


def test_encoder_keeps_a_bounded_number_of_words():
    encode = hashing_encoder(16)()
    buckets = next(c.cell_contents for c in encode.__closure__ if isinstance(c.cell_contents, dict))
    most = 0
    for k in range(40):
        encode([" ".join(f"w{k}x{i}" for i in range(10_000))])
        most = max(most, len(buckets))
    assert most <= 120_000


def test_index_and_text_search(spark):
    rows = spark.createDataFrame(
        [
            ("E.csv", "Equipment", 1, {"Equipment_ID": "E1", "Criticality": "H"}, "red pump in hall"),
            ("E.csv", "Equipment", 2, {"Equipment_ID": "E2"}, "blue fan on roof"),
            ("M.csv", "Materials", 1, {"Material_ID": "M1"}, "seal for pump"),
        ],
        "source_file string, source_type string, row_number bigint, json_data map<string,string>, semantic_statement string",
    )
    encoders = (hashing_encoder(64), hashing_encoder(64))
    index = build_index(rows, *encoders)
    assert {(r["rec_id"], r["id"]) for r in index.collect()} == {(0, "E1"), (1, "E2"), (2, "unknown_M1")}
    hits = search(index, query_table(spark, [("blue fan on roof", 0.9)]), *encoders, 2).orderBy("rank").collect()
    assert hits[0]["id"] == "E2" and hits[0]["focus"] == "Semantic-focused" and hits[0]["semantic_score"] == 1.0


# ------------------------------------------------------------------ names and chains


def test_containment_matches_brute_force(spark):
    words = ["pump", "PUMP 12", "seal", "a", "1 se", "zz", "", "Éa", "pump 12" * 30, "nothing at all " * 5]
    texts = ["Big Pump 12 seal", "seal", "PUMP", "nothing", None, "xÉAx", "pump 12" * 5000, "Nothing at all " * 9]
    names = spark.createDataFrame([(w,) for w in words], "n string")
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    want = {(w.lower(), i) for w in words if w for i, t in enumerate(texts) if t and w.lower() in t.lower()}
    for long_name, block in ((48, 1_000_000), (48, 4), (3, 1_000_000), (1, 10)):
        got = [tuple(r) for r in containing_texts(names, "n", docs, "t", "i", long_name, block).collect()]
        assert set(got) == want and len(got) == len(want)


def test_resolution_order(spark):
    listed = spark.createDataFrame(
        [(1, "Pump A", "Pump A red", 1), (2, "Pump A", "Pump A blue", 2), (3, "Fan", "fan near pump b", 3), (4, "Duct", "PUMP B duct", 4)],
        "id int, name string, text string, row int",
    )
    names = spark.createDataFrame([("Pump A",), ("pump b",), ("Ghost",)], "n string")
    got = {r["name"]: (r["record_id"], r["how"]) for r in resolve_names(names, "n", listed, "name", "text", "id", "row").collect()}
    assert got == {"Pump A": ("2", "exact"), "pump b": ("4", "contained"), "Ghost": ("Ghost", "unresolved")}


def test_names_are_exchanged_once_and_few_names_leave_the_texts_where_they_are(spark, monkeypatch):
    listed = spark.createDataFrame([(i, f"name {i % 7}" * 9, f"text {i} " * 30, i) for i in range(50)], "id int, name string, text string, row int")
    names = listed.select("name").union(spark.createDataFrame([("text 7 " * 12,), ("lost " * 12,), (None,), (None,)], "n string"))
    got = resolve_names(names, "name", listed, "name", "text", "id", "row")
    want = {f"name {i % 7}" * 9: (str(i), "exact") for i in range(50)}
    want |= {"text 7 " * 12: ("7", "contained"), "lost " * 12: ("lost " * 12, "unresolved"), None: (None, "unresolved")}
    assert sorted(map(str, got.collect())) == sorted(str(Row(name=n, record_id=r, how=h)) for n, (r, h) in want.items())
    plans = []
    written = R.written
    monkeypatch.setattr(R, "written", lambda df, purpose: plans.append((purpose, df)) or written(df, purpose))
    found = containing_texts(names, "name", listed, "text", "id")
    plan = dict(plans)["anchors"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert found.count() == 1


@pytest.fixture()
def chain(spark):
    bom = spark.createDataFrame([("E1", "M1", "Seal"), ("E1", "M2", None), ("E1", "M1", "Seal"), ("E2", "M3", None)], "Equipment_ID string, Material_ID string, Notes string")
    po = spark.createDataFrame([("M1", "V2"), ("M1", "V1"), ("M1", "V2"), ("M3", "V9"), (None, "V1")], "Material_ID string, Vendor_ID string")
    return bom, po


def test_nested_equipment_mapping(spark, chain):
    bom, po = chain
    got = map_equipment(
        spark.createDataFrame([("Pump",), ("Fan two",), ("Nothing",)], "Equipment_Name string"),
        spark.createDataFrame([("E1", "Pump"), ("E2", "Big fan two"), ("E3", "Spare")], "Equipment_ID string, Equipment_Name string"),
        spark.createDataFrame([("E1", "E1 pump", 1), ("E2", "E2 Big FAN TWO", 2), ("E3", "E3 spare", 3)], "Equipment_ID string, text string, row_number int"),
        bom,
        po,
        spark.createDataFrame([("M1", "Mechanical seal"), ("M2", "Sleeve")], "Material_ID string, Material_Name string"),
        spark.createDataFrame([("V1", "One"), ("V2", "Two")], "Vendor_ID string, Vendor_Name string"),
    )
    rows = {r["equipment"]: (r["equipment_id"], [(m["material"], m["material_id"], [tuple(v) for v in m["vendors"]]) for m in r["materials"]]) for r in got.collect()}
    assert rows == {
        "Pump": ("E1", [("Seal", "M1", [("V1", "One"), ("V2", "Two")]), ("Sleeve", "M2", [])]),
        "Fan two": ("E2", [("M3", "M3", [("V9", "V9")])]),
        "Nothing": ("Nothing", []),
    }
    assert M.with_materials(got).count() == 2


def test_names_that_share_a_record_keep_their_rows(spark, chain):
    bom, po = chain
    got = map_equipment(
        spark.createDataFrame([("Pump A",), ("pump a",), ("Fan",)], "Equipment_Name string"),
        spark.createDataFrame([("E1", "Pump A"), ("E2", "Fan")], "Equipment_ID string, Equipment_Name string"),
        spark.createDataFrame([("E1", "E1 pump a", 1), ("E2", "E2 fan", 2)], "Equipment_ID string, text string, row_number int"),
        bom,
        po,
        spark.createDataFrame([("M1", "Mechanical seal")], "Material_ID string, Material_Name string"),
        spark.createDataFrame([("V1", "One")], "Vendor_ID string, Vendor_Name string"),
    )
    assert {(r["equipment"], r["equipment_id"], len(r["materials"])) for r in got.collect()} == {
        ("Pump A", "E1", 2),
        ("pump a", "E1", 2),
        ("Fan", "E2", 1),
    }


def test_search_finds_names_and_fills_gaps(spark, chain):
    bom, po = chain
    headers = {"E": ["Equipment_ID", "Equipment_Name"], "M": ["Material_ID", "Material_Name"], "V": ["Vendor_ID", "Vendor_Name"]}
    rows = [
        ("E.csv", "Equipment", 1, ("E1", "red pump near tower")),
        ("M.csv", "Materials", 1, ("M2", "Sleeve")),
        ("V.csv", "Vendors", 1, ("V2", "Two and Sons")),
    ]
    tables = [
        build_records(spark.createDataFrame([(*cells, f, t, n)], [*headers[f[0]], "source_file", "source_type", "row_number"]))
        for f, t, n, cells in rows
    ]
    encoders = (hashing_encoder(64), hashing_encoder(64))
    index = build_index(tables[0].unionByName(tables[1], True).unionByName(tables[2], True), *encoders)
    got = map_equipment(
        spark.createDataFrame([("tower pump red",), ("zzz",)], "Equipment_Name string"),
        spark.createDataFrame([("E1", "red pump near tower")], "Equipment_ID string, Equipment_Name string"),
        spark.createDataFrame([("E1", "red pump near tower", 1)], "Equipment_ID string, text string, row_number int"),
        bom,
        po,
        spark.createDataFrame([("M1", "Mechanical seal")], "Material_ID string, Material_Name string"),
        spark.createDataFrame([("V1", "One")], "Vendor_ID string, Vendor_Name string"),
        index,
        encoders,
    )
    found = {r["equipment"]: r for r in got.collect()}
    assert (found["tower pump red"]["equipment_id"], found["tower pump red"]["how"]) == ("E1", "searched")
    shown = [(m["material"], [v["vendor_name"] for v in m["vendors"]]) for m in found["tower pump red"]["materials"]]
    assert shown == [("Seal", ["One", "Two and Sons"]), ("Sleeve", [])]


def test_mapping_counts_without_expanding(spark, chain):
    bom, po = chain
    owners = spark.createDataFrame([("E1",), ("E2",), ("E3",)], "Equipment_ID string")
    held = M.links(bom, "Equipment_ID", "Material_ID")
    totals = M.mapping_totals(owners, held, po, "Equipment_ID", "Material_ID", "Vendor_ID").first()
    assert tuple(totals) == (3, 2, 3, 3)
    bill = M.bill_of_parts(owners, bom, "Equipment_ID", "Material_ID")
    assert bill.count() == 4 and M.chain(bill, po, "Equipment_ID", "Material_ID", "Vendor_ID").count() == 5
    spread = {r["Vendor_ID"]: r["relationships"] for r in M.vendor_distribution(held, po, "Material_ID", "Vendor_ID").collect()}
    assert spread == {"V1": 1, "V2": 1, "V9": 1}


# ------------------------------------------------------------------------ profiles


def test_profile_and_plan(spark):
    rows = [("C.csv", "C", i, f"code{i}" if i != 2 else None, float(i) if i != 3 else None, i) for i in range(1, 8)]
    table = spark.createDataFrame(rows, "source_file string, source_type string, row_number bigint, code string, value double, n bigint")
    empty = table.filter("row_number < 0")
    got = {r["source_type"]: r for r in G.profiles({"C": table, "E": empty}).collect()}
    c = got["C"]
    # first five rows: code 5+0+5+5+5, value 3+3+0+3+3, n 1 each
    assert (c["rows"], c["columns"], c["text_columns"], c["numeric_columns"], c["null_cells"], c["max_chars"]) == (7, 3, 1, 2, 2, 9)
    assert abs(c["avg_chars"] - 37 / 5) < 1e-12 and abs(c["density"] - (1 - 2 / 15)) < 1e-12
    assert (got["E"]["rows"], got["E"]["avg_chars"], got["E"]["density"], got["E"]["null_percent"]) == (0, 0.0, 0.5, 0.0)
    plan = G.batch_plan(G.profile(table, "C")).first()
    assert plan["batch_size"] == 5 and plan["calls"] == 2 and plan["suggested_mode"].startswith("simple")
    assert G.plan_totals(G.batch_plan(G.profile(table, "C"))).first()["reduction_percent"] == pytest.approx(500 / 7)


def test_type_counts_and_costs(spark):
    rows = spark.createDataFrame([("a", "x" * 9, "y" * 3), ("a", "", "y" * 8), ("b", "x" * 4, None)], "type string, s string, t string")
    assert {tuple(r) for r in Z.type_counts(rows).collect()} == {("a", 2), ("b", 1), ("(all)", 3)}
    cost = Z.token_totals(rows, "s", "t").first()
    assert (cost["semantic_tokens"], cost["structured_tokens"]) == (3, 2)
    assert cost["total_cost"] == pytest.approx(3e-6 * 0.13 + 2e-6 * 0.02)


@pytest.mark.parametrize("cells", [35, 4_000_000])
def test_nearest_is_exact_however_rows_are_sliced(spark, monkeypatch, cells):
    monkeypatch.setattr(S, "DISTANCE_CELLS", cells)
    draw = np.random.default_rng(6)
    points = draw.integers(0, 4, (300, 2, 3)).astype(float)
    targets = draw.integers(0, 4, (7, 2, 3)).astype(float)
    rows = lambda some: [(k, a.tolist(), b.tolist()) for k, (a, b) in enumerate(some)]
    schema = "sem_vec array<double>, str_vec array<double>"
    corpus = spark.createDataFrame(rows(points), f"rec_id long, {schema}").repartition(3)
    queries = spark.createDataFrame(rows(targets), f"query_id long, {schema}")
    found = S.nearest(corpus, queries, 5).collect()
    got = {(r.query_id, r.stream, r["rank"]): (r.rec_id, r.distance) for r in found}
    for q, target in enumerate(targets):
        for s, name in enumerate(("semantic", "structured")):
            gaps = ((points[:, s] - target[s]) ** 2).sum(axis=1)
            for rank, k in enumerate(np.lexsort((np.arange(300), gaps))[:5], 1):
                assert got[q, name, rank] == (k, gaps[k])


def exchanges_by_file(rows) -> int:
    """Exchanges of the rows that have ``json_data`` by their file alone."""
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return plan.count("hashpartitioning(source_file")


@pytest.fixture()
def no_guessing(spark):
    """Joins as they are written: nothing is sent whole because it happens to be small."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_ordinals_leave_records_where_they_are(spark, no_guessing):
    rows = spark.range(1, 5).select(F.lit("a.csv").alias("source_file"), F.col("id").alias("row_number"))
    rows = rows.unionByName(spark.range(1, 3).select(F.lit("b.csv").alias("source_file"), F.col("id").alias("row_number")))
    numbered = O.with_ordinal(rows)
    # One exchange counts the rows of each file.
    assert exchanges_by_file(numbered) == 1
    assert sorted(r["ordinal"] for r in numbered.collect()) == list(range(6))


def test_stopping_leaves_described_rows_where_they_are(spark, no_guessing):
    rows = records(spark, {"a": 9, "b": 4})
    done = D.describe(rows, refusing(5), 2, "stop")
    assert exchanges_by_file(done) == 1
    status = {(r["source_file"], r["row_number"]): r["status"] for r in done.collect()}
    assert [status["a.csv", n] for n in range(1, 10)] == ["ok"] * 4 + ["failed"] * 2 + ["pending"] * 3
    assert {status["b.csv", n] for n in range(1, 5)} == {"ok"}


@pytest.mark.parametrize(("sellers", "kind"), [([1, 2, 300, 70_000, 2**40, None], "long"), (["b", "a", "é", "Z", "", None], "string"), ([], "long")])
def test_nested_vendors_travel_as_places(spark, monkeypatch, sellers, kind):
    owners = spark.createDataFrame([(k, f"o{k}") for k in range(6)], "o long, o_name string")
    held = spark.createDataFrame([(k, p) for k in range(5) for p in range(k + 3)] + [(0, 0), (1, None)], "o long, p long")
    bought = spark.createDataFrame([(p, s) for p in range(6) for s in sellers[p % 3 :]] + [(0, s) for s in sellers], f"p long, s {kind}")
    parts = spark.createDataFrame([(p, f"part {p}") for p in range(1, 9)], "p long, part_name string")
    # A name that is missing, one that is null and two for one vendor.
    names = spark.createDataFrame([(s, n) for s, n in zip(sellers, ("x", None, "y")) if s is not None] + [(s, "again") for s in sellers[:1]], f"s {kind}, s_name string")

    def nested(most):
        return M.nested_mapping(owners, held, bought, parts, names, "o", "o_name", "p", "s", "s_name", most)

    for most in (None, 2):
        packed = nested(most)
        plan = packed._jdf.queryExecution().optimizedPlan().toString()
        assert "vendor_name" not in plan.split("\n", 1)[1]
        with monkeypatch.context() as m:
            m.setattr(M, "MOST_LINKS", 3)
            rows = sorted(packed.collect())
        with monkeypatch.context() as m:
            m.setattr(M, "MOST_VENDORS", -1)
            plain = nested(most)
            assert "vendor_name" in plain._jdf.queryExecution().optimizedPlan().toString().split("\n", 1)[1]
            assert rows == sorted(plain.collect()) and len(rows) >= 6
        assert packed.dtypes == plain.dtypes
        assert any(e.vendors for r in rows for e in r.materials) == bool(sellers)


def test_packed_places():
    draw = np.random.default_rng(1)
    lists = [np.unique(draw.integers(0, 2**31 - 1, n)).tolist() for n in (0, 1, 5, 300, 0)] + [[0], [0, 127, 255, 16_510, 2**31 - 1], [0, 0, 3]]
    kept = {}

    class Rows:
        schema = T.StructType([T.StructField("v", T.ArrayType(T.IntegerType()))])

        def mapInArrow(self, run, schema):
            kept["run"] = run

    M._packed(Rows(), "v")
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], names=["v"])
    (packed,) = kept["run"]([batch.slice(1)])
    places, ends = M._numbers(packed.column(0))
    assert [places[a:b].tolist() for a, b in zip(ends, ends[1:])] == lists[1:]
    assert [len(x) for x in packed.column(0).to_pylist()][-3:] == [1, 11, 3]
    assert M._numbers(pa.array([b"", b""]))[1].tolist() == [0, 0, 0]
