"""Packed ids against the tokenizer as its JSON is loaded, where texts have its added tokens."""

import zlib

import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

from creditmart.llm import packing

TEXTS = [
    "<|endoftext|> x",
    "a <|endoftext|> x",
    "<|endoftext|><|endoftext|>",
    "a  \n<|endoftext|>\n\n b <|endoftext",
    "<|ENDOFTEXT|> it's",
    "none",
]


def test_ids_of_added_tokens(spark):
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r for r in packing.packed(docs).collect()}
    for doc_id, text in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        row = found[doc_id]
        assert (row.start, row.length, row.doc_tokens) == (0, len(ids), len(ids))
        assert row.ids_crc32 == zlib.crc32(ids.tobytes())
    assert found[1].doc_tokens == 5
