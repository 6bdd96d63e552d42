"""Entity chains over customers (owners), parts and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.catalog.registry import query
from recordloom.catalog.tables import entity, plain, table
from recordloom.functions import text as X
from recordloom.operators import mapping as M
from recordloom.operators import skew
from recordloom.operators.records import build_records, union_records, with_metadata
from recordloom.operators.resolving import containing_texts, resolve_names


def bom(spark, sf):
    """Owner-part links: the parts on a customer's orders."""
    orders = plain(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = plain(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(orders, "l_orderkey").select("o_custkey", "l_partkey")


def purchases(spark, sf):
    return plain(spark, sf, "lineitem").select("l_partkey", "l_suppkey")


def owners(spark, sf):
    return plain(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")


def part_names(spark, sf):
    return plain(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("part_name"))


def supplier_names(spark, sf):
    return plain(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")


_LINKS = """bom AS (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
  bought AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"""


def vendor_sets_sql(max_items: int = skew.MAX_ITEMS) -> str:
    return f"""WITH {_LINKS}, sized AS (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n FROM bought),
         dealt AS (SELECT *, {skew.chunk_sql("l_suppkey", "n", max_items)} AS chunk FROM sized)
       SELECT l_partkey, chunk, count(*) AS n_suppliers, array_to_string(list_sort(list(l_suppkey)), ',') AS suppliers
       FROM dealt GROUP BY l_partkey, chunk"""


@query(vendor_sets_sql())
def vendor_sets(spark, sf):
    sets = M.supplier_sets(purchases(spark, sf), "l_partkey", "l_suppkey")
    return sets.select(
        "l_partkey",
        "chunk",
        F.size("suppliers").cast("bigint").alias("n_suppliers"),
        F.concat_ws(",", F.col("suppliers").cast("array<string>")).alias("suppliers"),
    )


@query(
    f"""WITH {_LINKS} SELECT c_custkey AS o_custkey, l_partkey FROM customer LEFT JOIN bom ON c_custkey = o_custkey"""
)
def bom_expansion(spark, sf):
    return M.bill_of_parts(owners(spark, sf), bom(spark, sf), "o_custkey", "l_partkey")


@query(
    f"""WITH {_LINKS} SELECT l_partkey, l_suppkey, coalesce(s_name, CAST(l_suppkey AS VARCHAR)) AS vendor_name
        FROM bought LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0"""
)
def vendor_names(spark, sf):
    known = plain(spark, sf, "supplier").filter(F.col("s_acctbal") > 0)
    known = known.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    pairs = M.links(purchases(spark, sf), "l_partkey", "l_suppkey")
    return M.with_name(pairs, known, "l_suppkey", "s_name", "vendor_name")


@query(
    """SELECT l_partkey, coalesce(max(CASE WHEN l_returnflag = 'R' THEN l_linestatus || ' return' END), any_value(p_name),
         CAST(l_partkey AS VARCHAR)) AS part_name
       FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size > 20 GROUP BY l_partkey
       UNION ALL SELECT p_partkey, p_name FROM part WHERE p_size > 20 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem)"""
)
def material_names(spark, sf):
    notes = plain(spark, sf, "lineitem").select(
        "l_partkey",
        F.when(F.col("l_returnflag") == "R", F.concat("l_linestatus", F.lit(" return"))).alias("note"),
    )
    parts = plain(spark, sf, "part").filter(F.col("p_size") > 20)
    parts = parts.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    listed = parts.unionByName(
        notes.select("l_partkey", F.lit(None).cast("string").alias("p_name")).dropDuplicates(["l_partkey"])
    )
    return M.part_names(listed, notes, "l_partkey", "note", "p_name")


def vendor_name_lists_sql(max_items: int = skew.MAX_ITEMS) -> str:
    return f"""WITH {_LINKS}, sized AS (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n FROM bought),
         dealt AS (SELECT *, {skew.chunk_sql("l_suppkey", "n", max_items)} AS chunk FROM sized)
       SELECT l_partkey, chunk,
         array_to_string(list_sort(list(coalesce(s_name, CAST(l_suppkey AS VARCHAR)))), ', ') AS vendors
       FROM dealt LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_partkey, chunk"""


@query(vendor_name_lists_sql())
def vendor_name_lists(spark, sf):
    pairs = M.links(purchases(spark, sf), "l_partkey", "l_suppkey")
    named = M.with_name(pairs, supplier_names(spark, sf), "l_suppkey", "s_name", "vendor_name")
    lists = skew.nested_lists(named, ["l_partkey"], F.struct("vendor_name"), "vendors", F.col("l_suppkey"))
    return lists.select("l_partkey", "chunk", M.vendor_name_list(F.col("vendors")).alias("vendors"))


def nested_sql(max_items: int = skew.MAX_ITEMS) -> str:
    """Common table expressions up to ``nested``: the materials of each owner and chunk."""
    return f"""WITH {_LINKS},
  sold AS (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n FROM bought),
  vendors AS (
    SELECT l_partkey, {skew.chunk_sql("l_suppkey", "n", max_items)} AS vendor_chunk,
           list(struct_pack(vendor_id := l_suppkey, vendor_name := coalesce(s_name, CAST(l_suppkey AS VARCHAR)))
           ORDER BY l_suppkey) AS vendors
    FROM sold LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_partkey, vendor_chunk),
  entries AS (
    SELECT o_custkey, coalesce(p_name, CAST(b.l_partkey AS VARCHAR)) AS material, b.l_partkey AS material_id,
           vendor_chunk, vendors, count(*) OVER (PARTITION BY o_custkey) AS n
    FROM bom b LEFT JOIN part ON p_partkey = b.l_partkey LEFT JOIN vendors v ON v.l_partkey = b.l_partkey),
  dealt AS (SELECT *, {skew.chunk_sql("material_id", "n", max_items)} AS chunk FROM entries),
  owner_lists AS (
    SELECT o_custkey, chunk, list(struct_pack(material := material, material_id := material_id, vendors := vendors)
           ORDER BY material, material_id, vendor_chunk) AS materials,
           count(DISTINCT material_id) AS n_materials, sum(len(vendors)) AS n_links FROM dealt GROUP BY o_custkey, chunk),
  slots AS (
    SELECT c_custkey, c_name, unnest(range(greatest(1, CAST(ceil(coalesce(n, 0) / {float(max_items)}) AS BIGINT)))) AS chunk
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, n FROM entries) ON o_custkey = c_custkey),
  nested AS (
    SELECT c_custkey AS o_custkey, c_name, s.chunk, materials, coalesce(n_materials, 0) AS n_materials,
           CAST(coalesce(n_links, 0) AS BIGINT) AS n_vendor_links
    FROM slots s LEFT JOIN owner_lists l ON l.o_custkey = c_custkey AND l.chunk = s.chunk)"""


def mapping_of(spark, sf):
    return M.nested_mapping(
        owners(spark, sf),
        bom(spark, sf),
        purchases(spark, sf),
        part_names(spark, sf),
        supplier_names(spark, sf),
        "o_custkey",
        "c_name",
        "l_partkey",
        "l_suppkey",
        "s_name",
    )


def counted(nested, *names):
    """Distinct materials, vendor links and the text of each row of the nested mapping."""
    links = F.aggregate("materials", F.lit(0), lambda total, m: total + F.size(m["vendors"]))
    return nested.select(
        *(names or ("o_custkey", "c_name")),
        "chunk",
        F.size(F.array_distinct(F.transform("materials", lambda m: m["material_id"]))).cast("bigint").alias("n_materials"),
        links.cast("bigint").alias("n_vendor_links"),
        F.md5(F.to_json("materials")).alias("materials_md5"),
    )


def entity_mapping_sql(max_items: int = skew.MAX_ITEMS) -> str:
    return (
        nested_sql(max_items)
        + """ SELECT o_custkey, c_name, chunk, n_materials, n_vendor_links,
         md5(coalesce(CAST(to_json(materials) AS VARCHAR), '[]')) AS materials_md5 FROM nested"""
    )


@query(entity_mapping_sql())
def entity_mapping(spark, sf):
    return counted(mapping_of(spark, sf))


@query(
    f"""WITH {_LINKS} SELECT c_custkey AS o_custkey, b.l_partkey, l_suppkey
        FROM customer LEFT JOIN bom b ON c_custkey = o_custkey LEFT JOIN bought s ON s.l_partkey = b.l_partkey"""
)
def entity_chain(spark, sf):
    """The whole chain as flat links, which the nested mapping is a view of."""
    bill = M.bill_of_parts(owners(spark, sf), bom(spark, sf), "o_custkey", "l_partkey")
    return M.chain(bill, purchases(spark, sf), "o_custkey", "l_partkey", "l_suppkey")


@query(
    f"""WITH {_LINKS}, held AS (SELECT * FROM customer LEFT JOIN bom ON c_custkey = o_custkey),
         sold AS (SELECT l_partkey, count(*) AS n FROM bought GROUP BY 1)
       SELECT count(DISTINCT c_custkey) AS owners, count(DISTINCT o_custkey) AS owners_with_materials,
         count(h.l_partkey) AS materials, CAST(coalesce(sum(n), 0) AS BIGINT) AS vendor_links
       FROM held h LEFT JOIN sold s ON h.l_partkey = s.l_partkey"""
)
def mapping_totals(spark, sf):
    held = M.links(bom(spark, sf), "o_custkey", "l_partkey")
    return M.mapping_totals(owners(spark, sf), held, purchases(spark, sf), "o_custkey", "l_partkey", "l_suppkey")


@query(
    f"""WITH {_LINKS}, held AS (SELECT l_partkey, count(*) AS n FROM bom GROUP BY 1)
       SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS relationships, count(*) AS materials
       FROM bought JOIN held USING (l_partkey) GROUP BY l_suppkey"""
)
def vendor_distribution(spark, sf):
    held = M.links(bom(spark, sf), "o_custkey", "l_partkey")
    return M.vendor_distribution(held, purchases(spark, sf), "l_partkey", "l_suppkey")


@query(
    f"""WITH {_LINKS} SELECT c_custkey AS o_custkey, count(*) AS materials FROM customer JOIN bom ON c_custkey = o_custkey
        GROUP BY 1"""
)
def mapped_owners(spark, sf):
    held = M.links(bom(spark, sf), "o_custkey", "l_partkey")
    return M.mapped_owners(owners(spark, sf), held, "o_custkey", "l_partkey")


# ------------------------------------------------------------------- names to records


@query(
    """SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(lower(d.text), lower(b.text))"""
)
def containment(spark, sf):
    names = plain(spark, sf, "benchmark")
    pairs = containing_texts(names, "text", plain(spark, sf, "documents"), "text", "doc_id")
    keyed = names.select("item_id", F.lower("text").alias("name_key"))
    return keyed.join(pairs, "name_key").select("item_id", F.col("text_id").alias("doc_id"))


@query(
    """WITH names AS (SELECT DISTINCT text AS name FROM benchmark UNION SELECT DISTINCT text FROM documents),
         exact AS (SELECT name, max(doc_id) AS doc_id FROM names JOIN documents ON text = name GROUP BY 1),
         inside AS (SELECT name, max(doc_id) AS doc_id FROM names JOIN documents ON contains(lower(text), lower(name))
                    WHERE name NOT IN (SELECT name FROM exact) GROUP BY 1)
       SELECT md5(n.name) AS name_md5, md5(coalesce(CAST(e.doc_id AS VARCHAR), CAST(i.doc_id AS VARCHAR), n.name)) AS record_md5,
         CASE WHEN e.doc_id IS NOT NULL THEN 'exact' WHEN i.doc_id IS NOT NULL THEN 'contained' ELSE 'unresolved' END AS how
       FROM names n LEFT JOIN exact e ON e.name = n.name LEFT JOIN inside i ON i.name = n.name"""
)
def name_resolution(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "row_number")
    names = plain(spark, sf, "benchmark").select("text").union(documents.select("text"))
    found = resolve_names(names, "text", documents, "text", "text", "doc_id", "row_number")
    return found.select(F.md5("name").alias("name_md5"), F.md5("record_id").alias("record_md5"), "how")


@query(
    """SELECT p_name, max(p_partkey) AS last_key, arg_max(p_brand, p_partkey) AS last_brand FROM part GROUP BY p_name"""
)
def last_match(spark, sf):
    parts = table(spark, sf, "part")
    return parts.groupBy("p_name").agg(
        F.max_by("p_partkey", "row_number").alias("last_key"), F.max_by("p_brand", "row_number").alias("last_brand")
    )


@query(
    """SELECT 'Equipment' AS type, 'equipment' AS kind, CAST(c_custkey AS VARCHAR) AS value FROM customer
       UNION ALL SELECT 'Materials', 'material', 'MAT-' || p_partkey FROM part
       UNION ALL SELECT 'Vendors', 'vendor', 'V-' || s_suppkey FROM supplier"""
)
def id_sets(spark, sf):
    parts = entity(spark, sf, "Materials").withColumn("Material_ID", F.concat(F.lit("MAT-"), "Material_ID"))
    sellers = entity(spark, sf, "Vendors").withColumn("Vendor_ID", F.concat(F.lit("V-"), "Vendor_ID"))
    records = union_records([build_records(t) for t in (entity(spark, sf, "Equipment"), parts, sellers)])
    found = with_metadata(records)
    # Suppliers have no identifier key of their own, so their record id is taken from the supplier key.
    seller = F.element_at("json_data", "Vendor_ID")
    named = found.withColumn("id", F.coalesce(seller, F.col("id")))
    return M.mapping_id_sets(named, "type")
