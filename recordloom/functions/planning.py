"""Token, cost and batch-size rules as expressions over a one-row-per-table profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.constants import (
    BATCH_TOKENS_GOOD_BELOW,
    BATCH_TOKENS_HIGH_ABOVE,
    CHARS_PER_TOKEN,
    MAX_BATCH,
    MIN_BATCH,
    SEMANTIC_USD_PER_MILLION_TOKENS,
    STRUCTURED_USD_PER_MILLION_TOKENS,
    TOKENS_PER_ROW_OVERHEAD,
)

# --- fixed values: (upper bound, batch size) steps, then the size past the last bound ---
TOKEN_STEPS = [(50, 25), (100, 20), (200, 15), (400, 10)]
TOKEN_REST = 5
CHAR_STEPS = [(100, 20), (300, 15), (500, 10)]
CHAR_REST = 5
MODE_STEPS = [
    (10, "simple - Small file (<10 rows)"),
    (50, "optimized (batch_size=5) - Medium file"),
    (200, "optimized (batch_size=10) - Large file"),
]
MODE_REST = "optimized (batch_size=20) - Very large file"
DEFAULT_BATCH = 10


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / CHARS_PER_TOKEN)


def tokens_per_row(avg_chars: Column) -> Column:
    return avg_chars / CHARS_PER_TOKEN + TOKENS_PER_ROW_OVERHEAD


def tokens_per_batch(avg_chars: Column, batch_size: Column) -> Column:
    return avg_chars * batch_size / CHARS_PER_TOKEN + batch_size * TOKENS_PER_ROW_OVERHEAD


def batch_token_flag(batch_tokens: Column) -> Column:
    return F.when(batch_tokens < BATCH_TOKENS_GOOD_BELOW, F.lit("Good")).otherwise(F.lit("High"))


def load_warning(row_tokens: Column, batch_size: Column) -> Column:
    """The report's remark on a table's planned batches."""
    return (
        F.when(row_tokens * batch_size > BATCH_TOKENS_HIGH_ABOVE, F.lit("high token usage"))
        .when(batch_size == 1, F.lit("single row batches"))
        .otherwise(F.lit("appropriate"))
    )


def semantic_cost(tokens: Column) -> Column:
    return tokens / 1_000_000 * SEMANTIC_USD_PER_MILLION_TOKENS


def structured_cost(tokens: Column) -> Column:
    return tokens / 1_000_000 * STRUCTURED_USD_PER_MILLION_TOKENS


def _stepped(value: Column, steps, rest, inclusive: bool = False) -> Column:
    picked = None
    for bound, result in steps:
        hit = value <= bound if inclusive else value < bound
        picked = F.when(hit, F.lit(result)) if picked is None else picked.when(hit, F.lit(result))
    return picked.otherwise(F.lit(rest))


def _bounded(size: Column) -> Column:
    return F.greatest(F.lit(MIN_BATCH), F.least(F.lit(MAX_BATCH), size))


def batch_size_by_tokens(rows: Column, avg_chars: Column, density: Column) -> Column:
    """Batch size from estimated tokens, then file size, then how full the cells are."""
    stepped = _stepped(tokens_per_row(avg_chars), TOKEN_STEPS, TOKEN_REST)
    fitted = (
        F.when(rows < 10, F.least(stepped, rows.cast("int")))
        .when(rows < 50, F.least(stepped, F.lit(10)))
        .otherwise(stepped)
    )
    factor = F.when(density < 0.3, F.lit(1.5)).when(density > 0.8, F.lit(0.8)).otherwise(F.lit(1.0))
    return _bounded((fitted * factor).cast("int"))


def batch_size_by_chars(avg_chars: Column) -> Column:
    return _bounded(_stepped(avg_chars, CHAR_STEPS, CHAR_REST))


def detected_mode(is_folder: Column, is_csv: Column, rows: Column, size_mb: Column) -> Column:
    """``folder``, ``simple`` or ``optimized``; unreadable statistics count as simple."""
    small = (rows <= 10) | (size_mb < 0.5) | rows.isNull() | size_mb.isNull()
    return (
        F.when(is_folder, F.lit("folder"))
        .when(~is_csv | small, F.lit("simple"))
        .otherwise(F.lit("optimized"))
    )


def detected_batch_size(mode: Column, rows: Column, default: int = DEFAULT_BATCH) -> Column:
    resized = F.least(F.lit(20), F.floor(rows / 10).cast("int"))
    return F.when((mode == "optimized") & (rows > 100), resized).otherwise(F.lit(default))


def suggested_mode(rows: Column) -> Column:
    return _stepped(rows, MODE_STEPS, MODE_REST, inclusive=True)


def calls_needed(rows: Column, batch_size: Column) -> Column:
    return F.ceil(rows / batch_size)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` as a percentage, 0 when there is nothing to divide by."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
