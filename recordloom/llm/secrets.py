"""Operator 10: secret scans judged by who owns copies of a candidate; built-in functions only.

Each kind's pattern splits a text into the pieces between its matches, so that a match
starts where the lengths of the pieces and matches before it end. Then each candidate's
value is hashed and the distinct repositories and owners that hold it are counted over
the corpus: values that many owners hold are widely copied examples, the others look live.
A repository is a ``source``; its owner is what stands before the first ``/`` of it.

Null and empty texts have no spans. A null source counts as one repository of its own.
Repeated rows are scanned each on their own, and count once as owners. Spans of different
kinds may overlap. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordloom.llm.common import stored, table, utf8

# Kind, pattern, group that holds the value, least characters of that group,
# and literals of which a text must hold one (a plain search that spares most texts the pattern).
BASE = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        (":", "="),
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, ("AKIA",)),
    ("hex", r"[0-9a-f]{16,}", 0, 16, ()),
)
# Key formats that vendors publish, and headers of private keys.
ADDED = (
    ("github", r"gh[opusr]_[A-Za-z0-9]{36,}", 0, 40, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, ("xox",)),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30, ("eyJ",)),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20, ("-----BEGIN ",)),
)
KINDS = BASE + ADDED
RANK = {kind: k for k, (kind, *_) in enumerate(KINDS)}
SHARED_OWNERS = 3


def _pieces(text: Column, pattern: str, group: int, least: int) -> Column:
    """For each match: the length of the piece before it, the match, and its value if it is long enough."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    found = F.transform(
        F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("match"), value.alias("value")),
        lambda x: F.struct(
            x["gap"].alias("gap"),
            F.length(x["match"]).alias("width"),
            F.when(F.length(x["value"]) >= least, x["value"]).alias("value"),
        ),
    )
    # Most texts have no match and are searched once only.
    return F.when(text.rlike(pattern), found)


def spans(docs: DataFrame, *kept: str) -> DataFrame:
    """A row per span: kept columns, kind, start and end (code points, end exclusive), value.

    ``docs`` needs ``uid`` (unique per row) and ``text``.
    """
    text = utf8(F.col("text"))
    kinds = [
        F.struct(F.lit(RANK[kind]).alias("kind"), _pieces(text, pattern, group, least).alias("found"))
        for kind, pattern, group, least, _ in KINDS
    ]
    found = docs.select(*kept, F.array(*kinds).alias("kinds"))
    found = found.where(F.exists("kinds", lambda k: k["found"].isNotNull()))
    each = found.select(*kept, F.inline("kinds")).select(*kept, "kind", F.posexplode("found").alias("at", "m"))
    before = Window.partitionBy("uid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.width")).over(before)
    placed = each.select(*kept, "kind", "m.width", "m.value", end.alias("end"))
    return placed.where(F.col("value").isNotNull()).select(
        *kept, "kind", (F.col("end") - F.col("width")).alias("start"), "end", "value"
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per value (as ``value_hash``): distinct repositories and owners that hold it.

    Copies within a repository are counted out on each task before anything is exchanged.
    """
    repository = F.coalesce("source", F.lit(""))
    held = found.select("value_hash", repository.alias("repository")).distinct()
    held = held.withColumn("owner", F.split("repository", "/", 2)[0])
    owners = held.groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"))
    return owners.groupBy("value_hash").agg(
        F.sum("repositories").alias("repositories"), F.count("*").alias("owners")
    )


def judged(docs: DataFrame, shared_owners: int = SHARED_OWNERS) -> DataFrame:
    """The spans of ``docs`` (uid, text, source) with ``repositories``, ``owners`` and ``live``."""
    found = spans(docs, "uid", "source").withColumn("value_hash", F.xxhash64("value"))
    found = stored(found.drop("value"))
    return found.join(ownership(found), "value_hash").withColumn("live", F.col("owners") < shared_owners)


def _joined(spans_: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind, *_ in KINDS])
    texts = F.transform(
        spans_, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")


def scan(docs: DataFrame, shared_owners: int = SHARED_OWNERS) -> DataFrame:
    """Per row of ``docs`` (uid, doc_id, text, source): counts and places of its secrets."""
    found = judged(docs, shared_owners).groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("found")
    )
    held = F.coalesce("found", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>"))

    def count(test) -> Column:
        return F.size(F.filter(held, test)).cast("long")

    base = F.filter(held, lambda s: s["kind"] < len(BASE))
    return docs.select("uid", "doc_id").join(found, "uid", "left").select(
        "doc_id",
        count(lambda s: s["kind"] == 0).alias("n_assign"),
        count(lambda s: s["kind"] == 1).alias("n_access"),
        count(lambda s: s["kind"] == 2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(held).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_shared"),
    )


def _hit(text: Column) -> Column:
    """Whether a text holds a candidate of any kind."""
    hit = F.lit(False)
    for _, pattern, _, _, literals in KINDS:
        there = F.lit(not literals)
        for literal in literals:
            there = there | text.contains(literal)
        hit = hit | (there & text.rlike(pattern))
    return hit


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, source and text of every row with a ``uid``, stored so that uids last; texts only where needed."""
    text = F.when(_hit(utf8(F.col("text"))), F.col("text"))
    rows = docs.select("doc_id", "source", text.alias("text"))
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()))


def redacted(docs: DataFrame, shared_owners: int = SHARED_OWNERS) -> DataFrame:
    """``docs`` with every secret replaced: ``[SECRET]`` if it looks live, ``[EXAMPLE]`` if widely copied.

    Overlapping spans are replaced as one, live if one of them is. Other rows stay as they are.
    """
    columns = docs.columns
    marked = docs.withColumn("__hit", _hit(utf8(F.col("text"))))
    # Only rows with a candidate are stored and joined.
    held = stored(marked.where("__hit").drop("__hit").withColumn("__uid", F.monotonically_increasing_id()))
    found = judged(held.select(F.col("__uid").alias("uid"), "text", "source"), shared_owners)
    reach = Window.partitionBy("uid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = (F.col("start") >= F.coalesce(F.max("end").over(reach), F.lit(-1))).cast("int")
    so_far = Window.partitionBy("uid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    runs = found.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(so_far))
    runs = runs.groupBy("uid", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("live").alias("live")
    )
    runs = runs.groupBy(F.col("uid").alias("__uid")).agg(F.array_sort(F.collect_list(F.struct("start", "end", "live"))).alias("__runs"))
    mark = lambda r: F.when(r["live"], F.lit("[SECRET]")).otherwise(F.lit("[EXAMPLE]"))
    starts = F.transform("__runs", lambda r: r["start"])
    stop = F.concat(F.slice(starts, 2, F.size("__runs")), F.array(F.length("text").cast("bigint")))
    kept = F.transform(
        F.arrays_zip(F.col("__runs").alias("run"), stop.alias("stop")),
        lambda x: F.concat(
            mark(x["run"]),
            F.substring(
                F.col("text"), (x["run"]["end"] + 1).cast("int"), (x["stop"] - x["run"]["end"]).cast("int")
            ),
        ),
    )
    first = F.substring(F.col("text"), F.lit(1), F.get(F.col("__runs"), F.lit(0))["start"].cast("int"))
    changed = held.join(runs, "__uid", "left").withColumn(
        "text",
        F.when(F.col("__runs").isNull(), F.col("text")).otherwise(F.concat(first, F.array_join(kept, ""))),
    )
    return marked.where(~F.col("__hit")).select(*columns).unionByName(changed.select(*columns))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(numbered(table(spark, sf_dir, "documents")))
