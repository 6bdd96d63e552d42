"""The registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from recordloom.llm.binary_ids import op9_binary_ids
from recordloom.llm.decontamination import op8_decontamination
from recordloom.llm.jaccard import OP12_SQL, op12_jaccard_join
from recordloom.llm.language import op6_language
from recordloom.llm.lexical import OP11_SQL, op11_lexical_search
from recordloom.llm.licenses import op3_license_scan
from recordloom.llm.packing import op2_packing
from recordloom.llm.quality import op4_quality
from recordloom.llm.repeats import op1_suffix_dedup
from recordloom.llm.secrets import op10_secret_scan
from recordloom.llm.simhash import op7_simhash
from recordloom.llm.spelling import OP13_SQL, op13_spelling_variants
from recordloom.llm.syncmers import op5_syncmers

QUERIES = {
    q.__name__: q
    for q in (
        op1_suffix_dedup,
        op2_packing,
        op3_license_scan,
        op4_quality,
        op5_syncmers,
        op6_language,
        op7_simhash,
        op8_decontamination,
        op9_binary_ids,
        op10_secret_scan,
        op11_lexical_search,
        op12_jaccard_join,
        op13_spelling_variants,
    )
}
ORACLES: dict[str, str] = {
    "op11_lexical_search": OP11_SQL,
    "op12_jaccard_join": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
