"""Vector search: the embedding table's two halves are the two streams."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.catalog import chains
from recordloom.catalog.registry import query
from recordloom.catalog.tables import entity, entity_records, plain, sql_entities, table
from recordloom.constants import ENTITY_PHRASINGS
from recordloom.functions import scoring as C
from recordloom.operators import searching as S
from recordloom.operators.embedding import embedded, hashing_encoder
from recordloom.operators.records import build_records, with_ordinal
from recordloom.plans import entity_map
from recordloom.plans.search_index import build_index as build_search_index
from recordloom.plans.search_index import entity_search, query_table, search
from recordloom.session import fresh_folder
from recordloom.sinks.vectors import read_vectors, write_vectors

HALF = 32
K = 10


def corpus(spark, sf):
    whole = F.col("embedding")
    return plain(spark, sf, "embeddings").select(
        F.col("vec_id").alias("rec_id"),
        "label",
        F.slice(whole, 1, HALF).alias("sem_vec"),
        F.slice(whole, HALF + 1, HALF).alias("str_vec"),
    )


def label_queries(spark, sf):
    """One query per label: the mean vector of its records, with an alpha that depends on the label."""
    positions = plain(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("at", "x"))
    means = positions.groupBy("label", "at").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    vectors = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v"))
    whole = F.transform("v", lambda p: p["x"])
    return vectors.select(
        F.col("label").cast("bigint").alias("query_id"),
        ((F.col("label") % 11) / 10).alias("alpha"),
        F.slice(whole, 1, HALF).alias("sem_vec"),
        F.slice(whole, HALF + 1, HALF).alias("str_vec"),
    )


_QUERIES = f"""points AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
  means AS (SELECT label, pos, round(avg(x), 6) AS x FROM points GROUP BY 1, 2),
  queries AS (SELECT CAST(label AS BIGINT) AS query_id, (label % 11) / 10 AS alpha, list(x ORDER BY pos) AS v FROM means GROUP BY label),
  measured AS (
    SELECT query_id, alpha, vec_id AS rec_id, label,
      round(pow(list_distance(v[1:{HALF}], embedding[1:{HALF}]::DOUBLE[]), 2), 10) AS sem,
      round(pow(list_distance(v[{HALF + 1}:{2 * HALF}], embedding[{HALF + 1}:{2 * HALF}]::DOUBLE[]), 2), 10) AS str
    FROM queries, embeddings),
  lists AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sem, rec_id) AS sem_rank,
      row_number() OVER (PARTITION BY query_id ORDER BY str, rec_id) AS str_rank FROM measured)"""

_PAIRED = (
    _QUERIES
    + """, paired AS (
    SELECT a.query_id, a.alpha, a.rec_id, a.label, a.sem_rank AS list_rank, 1 / (1 + a.sem) AS semantic_score,
      1 / (1 + b.str) AS structured_score
    FROM lists a JOIN lists b ON a.query_id = b.query_id AND a.sem_rank = b.str_rank)"""
)


def _scores(hits):
    return hits.withColumns(
        {c: F.round(c, 6) for c in ("semantic_score", "structured_score", "combined_score") if c in hits.columns}
    )


@query(
    f"""WITH {_QUERIES} SELECT query_id, 'semantic' AS stream, sem_rank AS rank, rec_id, round(sem, 6) AS distance
          FROM lists WHERE sem_rank <= {K}
        UNION ALL SELECT query_id, 'structured', str_rank, rec_id, round(str, 6) FROM lists WHERE str_rank <= {K}"""
)
def knn(spark, sf):
    found = S.nearest(corpus(spark, sf), label_queries(spark, sf), K)
    return found.select(
        "query_id", "stream", F.col("rank").cast("bigint").alias("rank"), "rec_id", F.round("distance", 6).alias("distance")
    )


@query(
    f"""WITH {_PAIRED} SELECT query_id, alpha, rec_id, round(semantic_score, 6) AS semantic_score,
         round(structured_score, 6) AS structured_score,
         round(alpha * semantic_score + (1 - alpha) * structured_score, 6) AS combined_score,
         row_number() OVER (PARTITION BY query_id ORDER BY alpha * semantic_score + (1 - alpha) * structured_score DESC, list_rank) AS rank,
         CASE WHEN alpha > 0.6 THEN 'Semantic-focused' WHEN alpha < 0.4 THEN 'Structured-focused' ELSE 'Balanced' END AS focus
       FROM paired WHERE list_rank <= {K}"""
)
def hybrid_rank_fusion(spark, sf):
    hits = S.hybrid_search(corpus(spark, sf), label_queries(spark, sf), K, "rank")
    return _scores(hits).select(
        "query_id",
        "alpha",
        "rec_id",
        "semantic_score",
        "structured_score",
        "combined_score",
        F.col("rank").cast("bigint").alias("rank"),
        C.alpha_label(F.col("alpha")).alias("focus"),
    )


@query(
    f"""WITH {_QUERIES}, either AS (SELECT * FROM lists WHERE sem_rank <= {K} OR str_rank <= {K}),
         scored AS (SELECT query_id, rec_id, 1 / (1 + sem) AS s, 1 / (1 + str) AS t,
           alpha / (1 + sem) + (1 - alpha) / (1 + str) AS c FROM either)
       SELECT query_id, rec_id, round(s, 6) AS semantic_score, round(t, 6) AS structured_score, round(c, 6) AS combined_score,
         row_number() OVER (PARTITION BY query_id ORDER BY c DESC, rec_id) AS rank FROM scored QUALIFY rank <= {K}"""
)
def hybrid_id_fusion(spark, sf):
    hits = S.hybrid_search(corpus(spark, sf), label_queries(spark, sf), K, "id")
    return _scores(hits).select(
        "query_id",
        "rec_id",
        "semantic_score",
        "structured_score",
        "combined_score",
        F.col("rank").cast("bigint").alias("rank"),
    )


@query(
    f"""WITH {_PAIRED}, alphas AS (SELECT unnest([0.3, 0.5, 0.7])::DOUBLE AS swept)
       SELECT query_id, swept AS alpha, list_rank AS rank, rec_id, round(semantic_score, 6) AS semantic_score,
         round(structured_score, 6) AS structured_score,
         round(swept * semantic_score + (1 - swept) * structured_score, 6) AS combined_score
       FROM paired, alphas WHERE list_rank <= 3"""
)
def alpha_sweep(spark, sf):
    hits = S.alpha_sweep(corpus(spark, sf), label_queries(spark, sf), [0.3, 0.5, 0.7], 3)
    return _scores(hits).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    f"""WITH {_PAIRED} SELECT query_id, rec_id, label, list_rank AS rank, round(semantic_score, 6) AS semantic_score
        FROM paired WHERE list_rank <= {K}"""
)
def hit_metadata(spark, sf):
    records = corpus(spark, sf)
    hits = S.hybrid_search(records, label_queries(spark, sf), K, "rank")
    joined = S.with_record(hits, records, ["label"])
    return joined.select(
        "query_id", "rec_id", "label", F.col("rank").cast("bigint").alias("rank"), F.round("semantic_score", 6).alias("semantic_score")
    )


@query(
    f"""WITH {_PAIRED}, once AS (
         SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY list_rank) AS seen FROM paired WHERE list_rank <= {K})
       SELECT query_id, label, rec_id, row_number() OVER (PARTITION BY query_id ORDER BY list_rank) AS rank FROM once
       WHERE seen = 1 QUALIFY rank <= 5"""
)
def hit_dedupe(spark, sf):
    records = corpus(spark, sf)
    hits = S.with_record(S.hybrid_search(records, label_queries(spark, sf), K, "rank"), records, ["label"])
    once = S.first_seen(hits, "label", 5)
    return once.select("query_id", "label", "rec_id", F.col("rank").cast("bigint").alias("rank"))


@query(
    """SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank
       FROM events QUALIFY rank <= 10"""
)
def top_k_per_group(spark, sf):
    rows = plain(spark, sf, "events").select("event_type", "event_id", "value")
    best = S.top_ranked(rows, ["event_type"], [F.desc("value"), F.col("event_id")], 10)
    return best.select("event_type", "event_id", "value", F.col("rank").cast("bigint").alias("rank"))


@query(
    """SELECT event_id, greatest(0.0, least(1.0, coalesce(try_cast(CASE WHEN event_type = 'error' THEN 'high' ELSE
           CAST(value / 10 - 1 AS VARCHAR) END AS DOUBLE), 0.5))) AS alpha,
         CASE WHEN event_type = 'view' THEN 5 ELSE CAST(greatest(1, least(10, user_id - 2)) AS INTEGER) END AS k FROM events"""
)
def parameter_clamping(spark, sf):
    value = F.col("value")
    asked = plain(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "high").otherwise((value / 10 - 1).cast("string")).alias("alpha_text"),
        F.when(F.col("event_type") == "view", "2.5").otherwise((F.col("user_id") - 2).cast("string")).alias("k_text"),
    )
    return asked.select(
        "event_id", C.clamped_alpha(F.col("alpha_text")).alias("alpha"), C.clamped_k(F.col("k_text")).alias("k")
    )


@query(
    """SELECT s_name AS entity, phrasing, text, alpha FROM supplier, LATERAL (
         SELECT 'parts' AS phrasing, s_name || ' spare parts materials' AS text, 0.5::DOUBLE AS alpha
         UNION ALL SELECT 'maintenance', s_name || ' maintenance components', 0.6::DOUBLE
         UNION ALL SELECT 'direct', s_name, 0.3::DOUBLE)"""
)
def entity_phrasings(spark, sf):
    return S.entity_queries(plain(spark, sf, "supplier"), "s_name", ENTITY_PHRASINGS)


# ------------------------------------------------------------- text encoder and search

DIMENSIONS = 32


def _counts_sql(name: str, text: str, key: str, source: str, salt: str = "") -> str:
    """CTE ``<name>``: (key, bucket, weight) of the words of ``text``, scaled to unit length in single precision."""
    return f"""{name}_words AS (SELECT {key}, unnest(string_split(lower({text}), ' ')) AS word FROM {source}),
      {name}_counts AS (SELECT {key}, ('0x' || substr(md5('{salt}' || word), 1, 7))::BIGINT % {DIMENSIONS} AS bucket,
                        count(*)::DOUBLE AS n FROM {name}_words WHERE word <> '' GROUP BY ALL),
      {name} AS (SELECT {key}, bucket, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT)::DOUBLE AS weight
                 FROM {name}_counts)"""


def _dense_sql(name: str, text: str, key: str, source: str, salt: str = "") -> str:
    """CTE ``<name>_dense``: one full vector per key."""
    return f"""{_counts_sql(name, text, key, source, salt)},
      {name}_dense AS (SELECT {key}, list(coalesce(weight, 0.0) ORDER BY bucket) AS v
        FROM (SELECT {key}, unnest(range({DIMENSIONS})) AS bucket FROM {source}) LEFT JOIN {name} USING ({key}, bucket) GROUP BY {key})"""


_INDEX_SQL = f"""{sql_entities()}, indexed AS (
    SELECT row_number() OVER (ORDER BY source_file, row_number) - 1 AS rec_id, source_type AS type,
      CASE WHEN source_type = 'Equipment' THEN json_extract_string(json_data, 'Equipment_ID')
           WHEN source_type = 'Functional_Locations' THEN json_extract_string(json_data, 'FL_ID')
           WHEN source_type = 'Materials' THEN 'unknown_' || json_extract_string(json_data, 'Material_ID')
           ELSE 'row_' || row_number END AS id,
      CASE WHEN source_type IN ('Equipment', 'Work_Orders') THEN json_extract_string(json_data, 'Criticality')
           ELSE 'N/A' END AS criticality, semantic_statement, structured_text FROM entities),
  {_dense_sql('sem', 'semantic_statement', 'rec_id', 'indexed')},
  {_dense_sql('str', 'structured_text', 'rec_id', 'indexed', 'field ')}"""


def _search_sql(asked: str, k: int) -> str:
    """CTEs up to ``hits``: rank-paired hybrid search of the ``asked(query_id, text, alpha)`` rows."""
    square = lambda a, b: f"round(pow(list_distance({a}, {b}), 2), 10)"
    return f"""{_INDEX_SQL}, asked AS ({asked}),
  {_dense_sql('qsem', 'text', 'query_id', 'asked')}, {_dense_sql('qstr', 'text', 'query_id', 'asked', 'field ')},
  lists AS (
    SELECT query_id, alpha, rec_id, {square('q.v', 's.v')} AS sem, {square('p.v', 't.v')} AS str
    FROM asked JOIN qsem_dense q USING (query_id) JOIN qstr_dense p USING (query_id),
      sem_dense s JOIN str_dense t USING (rec_id)),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sem, rec_id) AS sem_rank,
      row_number() OVER (PARTITION BY query_id ORDER BY str, rec_id) AS str_rank FROM lists),
  scored AS (
    SELECT a.query_id, a.alpha, a.rec_id, a.sem_rank AS list_rank, 1 / (1 + a.sem) AS s, 1 / (1 + b.str) AS t
    FROM ranked a JOIN ranked b ON a.query_id = b.query_id AND a.sem_rank = b.str_rank WHERE a.sem_rank <= {k}),
  hits AS (
    SELECT query_id, rec_id, alpha, s AS semantic_score, t AS structured_score, alpha * s + (1 - alpha) * t AS combined_score,
      row_number() OVER (PARTITION BY query_id ORDER BY alpha * s + (1 - alpha) * t DESC, list_rank) AS rank FROM scored)"""


@query(
    f"""WITH {_counts_sql('vectors', 'text', 'doc_id', 'documents')}
       SELECT doc_id, bucket, round(weight, 5) AS weight FROM vectors"""
)
def embed_text(spark, sf):
    vectors = plain(spark, sf, "documents").select(
        "doc_id", embedded(F.col("text"), hashing_encoder(DIMENSIONS)).alias("vector")
    )
    cells = vectors.select("doc_id", F.posexplode("vector").alias("bucket", "weight"))
    return cells.filter("weight > 0").select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("weight").cast("double"), 5).alias("weight")
    )


ENCODERS = (hashing_encoder(DIMENSIONS), hashing_encoder(DIMENSIONS, "field "))


def entity_index(spark, sf):
    """The tables are a file each, the largest with most of the rows."""
    return build_search_index(entity_records(spark, sf), *ENCODERS, int(spark.conf.get("spark.sql.shuffle.partitions")))


@query(
    f"""WITH {_INDEX_SQL},
         marks AS (SELECT rec_id, round(sum(weight * (bucket + 1)), 5) AS sem_mark FROM sem GROUP BY 1),
         marks2 AS (SELECT rec_id, round(sum(weight * (bucket + 1)), 5) AS str_mark FROM str GROUP BY 1)
       SELECT rec_id, id, type, criticality, sem_mark, str_mark FROM indexed JOIN marks USING (rec_id) JOIN marks2 USING (rec_id)"""
)
def build_index(spark, sf):
    mark = lambda v: F.round(
        F.aggregate(F.transform(v, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda t, x: t + x), 5
    )
    return entity_index(spark, sf).select(
        "rec_id", "id", "type", "criticality", mark(F.col("sem_vec")).alias("sem_mark"), mark(F.col("str_vec")).alias("str_mark")
    )


_ASKED = """SELECT DISTINCT c_mktsegment AS query_id, c_mktsegment AS text, 0.6::DOUBLE AS alpha FROM customer
            UNION ALL SELECT DISTINCT 'Class: ' || p_type, 'Class: ' || p_type, 0.3::DOUBLE FROM part"""


@query(
    f"""WITH {_search_sql(_ASKED, 5)}
       SELECT query_id, rec_id, alpha, id, type, criticality, rank, round(semantic_score, 6) AS semantic_score,
         round(structured_score, 6) AS structured_score, round(combined_score, 6) AS combined_score,
         CASE WHEN alpha > 0.6 THEN 'Semantic-focused' WHEN alpha < 0.4 THEN 'Structured-focused' ELSE 'Balanced' END AS focus
       FROM hits JOIN indexed USING (rec_id)"""
)
def text_hybrid_search(spark, sf):
    """Search for every market segment and part type found in the data."""
    segments = plain(spark, sf, "customer").select(F.col("c_mktsegment").alias("text")).distinct()
    kinds = plain(spark, sf, "part").select(F.concat(F.lit("Class: "), "p_type").alias("text")).distinct()
    texts = segments.withColumn("alpha", F.lit(0.6)).unionByName(kinds.withColumn("alpha", F.lit(0.3)))
    folder = fresh_folder(spark, "index")
    write_vectors(entity_index(spark, sf), folder)
    hits = search(read_vectors(spark, folder), texts.withColumn("query_id", F.col("text")), *ENCODERS, 5)
    return _scores(hits).withColumn("rank", F.col("rank").cast("bigint"))


_PHRASED = """SELECT n_name || chr(1) || phrasing AS query_id, replace(pattern, '{name}', n_name) AS text, alpha FROM nation, (
              VALUES ('parts', '{name} spare parts materials', 0.5::DOUBLE),
                     ('maintenance', '{name} maintenance components', 0.6::DOUBLE), ('direct', '{name}', 0.3::DOUBLE)
              ) AS p(phrasing, pattern, alpha)"""


@query(
    f"""WITH {_search_sql(_PHRASED, 10)}, typed AS (
         SELECT string_split(query_id, chr(1))[1] AS entity, string_split(query_id, chr(1))[2] AS phrasing, type, id, rec_id,
           round(combined_score, 6) AS combined_score FROM hits JOIN indexed USING (rec_id))
       SELECT entity, type, id, combined_score FROM typed
       QUALIFY row_number() OVER (PARTITION BY entity, type ORDER BY combined_score DESC, rec_id, phrasing) = 1"""
)
def multi_query_retrieval(spark, sf):
    """Three phrasings for every nation in one search, then each entity's best record per type."""
    index = entity_index(spark, sf)
    hits = entity_search(index, plain(spark, sf, "nation"), "n_name", *ENCODERS)
    typed = _scores(S.with_record(hits, index, ["type", "id"]))
    best = W.partitionBy("entity", "type").orderBy(F.desc("combined_score"), "rec_id", "phrasing")
    kept = typed.withColumn("place", F.row_number().over(best)).filter("place = 1")
    return kept.select("entity", "type", "id", "combined_score")


@query(
    """WITH asked AS (SELECT DISTINCT l_partkey FROM lineitem)
       SELECT l_partkey, coalesce(p_name, CAST(l_partkey AS VARCHAR)) AS part_name, p_partkey IS NULL AS unresolved
       FROM asked LEFT JOIN part ON p_partkey = l_partkey AND p_size > 20"""
)
def gap_fill_lookup(spark, sf):
    """Missing names by exact id; what stays unresolved would go to a search."""
    asked = plain(spark, sf, "lineitem").select("l_partkey").distinct()
    known = plain(spark, sf, "part").filter("p_size > 20").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    joined = asked.join(known, "l_partkey", "left")
    return joined.select(
        "l_partkey",
        F.coalesce("p_name", F.col("l_partkey").cast("string")).alias("part_name"),
        F.col("p_name").isNull().alias("unresolved"),
    )


@query(
    """SELECT vec_id AS rec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS ordinal FROM embeddings"""
)
def vector_ordinals(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("rec_id"), "label", "source_file", "row_number")
    return with_ordinal(rows).select("rec_id", "label", "ordinal")



_ODD_NAMES = "SELECT DISTINCT 'the Equipment_Name of ' || c_mktsegment AS name FROM customer UNION SELECT DISTINCT p_type FROM part"
_ASKED_NAMES = f"SELECT name AS query_id, name AS text, 0.3::DOUBLE AS alpha FROM ({_ODD_NAMES})"


@query(
    f"""{chains.nested_sql()}, {_search_sql(_ASKED_NAMES, 5)},
  best AS (SELECT query_id AS name, arg_min(id, rank) AS id FROM hits JOIN indexed USING (rec_id) WHERE type = 'Equipment' GROUP BY 1),
  resolved AS (
    SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS id, 'exact' AS how FROM customer
    UNION ALL SELECT lower(c_name), CAST(c_custkey AS VARCHAR), 'contained' FROM customer
    UNION ALL SELECT name, coalesce(id, name), CASE WHEN id IS NULL THEN 'unresolved' ELSE 'searched' END
    FROM ({_ODD_NAMES}) LEFT JOIN best USING (name))
  SELECT name AS equipment, id AS equipment_id, how, coalesce(chunk, 0) AS chunk, coalesce(n_materials, 0) AS n_materials,
    coalesce(n_vendor_links, 0) AS n_vendor_links, md5(coalesce(CAST(to_json(materials) AS VARCHAR), '[]')) AS materials_md5
  FROM resolved LEFT JOIN nested ON CAST(o_custkey AS VARCHAR) = id""".replace("WITH entities AS", "entities AS")
)
def map_equipment(spark, sf):
    """Listed names that match, differ in case, are only found by search or by nothing, with their chains."""
    people = plain(spark, sf, "customer")
    odd = people.select(F.concat(F.lit("the Equipment_Name of "), "c_mktsegment").alias("n")).union(
        plain(spark, sf, "part").select("p_type")
    )
    names = people.select("c_name").union(people.select(F.lower("c_name"))).union(odd.distinct())
    folder = fresh_folder(spark, "index")
    write_vectors(entity_index(spark, sf), folder)
    records = build_records(entity(spark, sf, "Equipment"))
    owner = F.col("o_custkey").cast("string").alias("Equipment_ID")
    nested = entity_map.map_equipment(
        names.toDF("Equipment_Name"),
        people.select(F.col("c_custkey").cast("string").alias("Equipment_ID"), F.col("c_name").alias("Equipment_Name")),
        records.select(
            F.element_at("json_data", "Equipment_ID").alias("Equipment_ID"), F.col("combined_text").alias("text"), "row_number"
        ),
        chains.bom(spark, sf).select(owner, F.col("l_partkey").alias("Material_ID"), F.lit(None).cast("string").alias("Notes")),
        chains.purchases(spark, sf).toDF("Material_ID", "Vendor_ID"),
        chains.part_names(spark, sf).toDF("Material_ID", "Material_Name"),
        chains.supplier_names(spark, sf).toDF("Vendor_ID", "Vendor_Name"),
        read_vectors(spark, folder),
        ENCODERS,
    )
    return chains.counted(nested, "equipment", "equipment_id", "how")


@query(
    f"""WITH {_counts_sql('vectors', 'text', 'item_id', 'benchmark')}
       SELECT item_id, bucket, round(weight, 5) AS weight FROM vectors"""
)
def embed_text_singly(spark, sf):
    """The encoder called with one text at a time."""
    vectors = plain(spark, sf, "benchmark").select(
        "item_id", embedded(F.col("text"), hashing_encoder(DIMENSIONS), batch_size=1).alias("vector")
    )
    cells = vectors.select("item_id", F.posexplode("vector").alias("bucket", "weight"))
    return cells.filter("weight > 0").select(
        "item_id", F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("weight").cast("double"), 5).alias("weight")
    )


CANNED = [
    ("Record with Equipment_ID", 0.7),
    ("Criticality: BUILDING", 0.2),
    ("Class: PROMO", 0.5),
    ("FL_Name", 0.3),
]
_CANNED_SQL = "SELECT CAST(k AS BIGINT) AS query_id, text, alpha FROM (VALUES " + ", ".join(
    f"({k}, '{text}', {alpha}::DOUBLE)" for k, (text, alpha) in enumerate(CANNED)
) + ") AS c(k, text, alpha)"


@query(
    f"""WITH {_search_sql(_CANNED_SQL, 3)}
       SELECT query_id, rec_id, type, rank, round(combined_score, 6) AS combined_score FROM hits JOIN indexed USING (rec_id)"""
)
def canned_queries(spark, sf):
    """A fixed list of questions, kept as a table, over a stored index."""
    folder = fresh_folder(spark, "canned")
    query_table(spark, CANNED).write.parquet(f"{folder}/queries")
    write_vectors(entity_index(spark, sf), f"{folder}/index")
    hits = search(read_vectors(spark, f"{folder}/index"), spark.read.parquet(f"{folder}/queries"), *ENCODERS, 3)
    return _scores(hits).select("query_id", "rec_id", "type", F.col("rank").cast("bigint").alias("rank"), "combined_score")
