"""What Python workers hold: batches and kept words are bounded."""

from __future__ import annotations

from array import array

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordloom.llm.common import by_arrow
from recordloom.llm.tokens import Encoder


def test_batches_of_long_texts_are_bounded(spark):
    def run(batches):
        for batch in batches:
            yield [(batch.num_rows, batch.nbytes)]

    texts = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("long "), 1 << 18).alias("text"))
    rows = by_arrow(texts, run, "n long, bytes long").collect()
    assert sum(r.n for r in rows) == 40
    assert max(r.bytes for r in rows) < 8 << 20


def test_few_kept_words_give_the_same_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = Encoder(path, 40), Tokenizer.from_file(path)
    for k in range(50):
        text = " ".join(f"the word{k}x{i} 7{i}, of" for i in range(k % 10 + 1)) + ("  end\n" if k % 3 else "")
        assert encoder.encode(text) == array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
        assert max(len(encoder.units), len(encoder.words)) <= 40 + len(text.split(" "))
