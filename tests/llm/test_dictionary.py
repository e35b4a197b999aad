"""What the shared dictionary of token files learns from."""

import random

from lifeline.llm import token_files
from lifeline.llm.queries import tokenizer


def test_tails_of_long_documents_shape_the_dictionary(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    tail = " ".join(word() for _ in range(100))
    rows = [(k, " ".join(word() for _ in range(600)) + "\n" + tail) for k in range(200)]
    path = tokenizer("byte_bpe_50k.json")
    docs = spark.createDataFrame([*rows, (200, None), (201, ""), (202, "short")], "doc_id bigint, text string")
    data = token_files.train_dictionary(docs, path)
    ids = token_files.Encoder(path)("\n" + tail)
    # 20 ids in a row from inside the tail
    known = sum(ids[k : k + 40] in data for k in range(100, len(ids) - 100, 2))
    assert known > len(ids) // 8
