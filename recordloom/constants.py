"""Fixed values that decide results. Everything tunable is a function argument instead."""

# --- fixed values: text layout -------------------------------------------------
FIELD_SEPARATOR = " | "
PROCESSED_SUFFIX = "_processed.json"
SUMMARY_MARKER = "processing_summary"

# --- fixed values: cell contents read as null (the public pandas.read_csv list) --
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# --- fixed values: token and cost model ------------------------------------------
CHARS_PER_TOKEN = 4
TOKENS_PER_ROW_OVERHEAD = 50
BATCH_TOKENS_GOOD_BELOW = 2500
BATCH_TOKENS_HIGH_ABOVE = 3000
SEMANTIC_USD_PER_MILLION_TOKENS = 0.13
STRUCTURED_USD_PER_MILLION_TOKENS = 0.02

# --- fixed values: profiling sample and batch bounds -------------------------------
SAMPLE_ROWS = 5
MIN_BATCH = 1
MAX_BATCH = 30

# --- fixed values: search defaults --------------------------------------------------
DEFAULT_ALPHA = 0.5
DEFAULT_K = 5
MAX_USER_K = 10
# (name, text pattern, alpha): the three phrasings used to look one entity up
ENTITY_PHRASINGS = [
    ("parts", "{name} spare parts materials", 0.5),
    ("maintenance", "{name} maintenance components", 0.6),
    ("direct", "{name}", 0.3),
]
