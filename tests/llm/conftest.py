import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns named like those that operators add
    *(T.StructField(c, T.StringType()) for c in ("n_shingles", "kept", "shard", "slot", "size", "row_key", "token_ids",
                                                 "n_lines", "rid", "sid", "key", "decoded", "bucket", "tie"))])


def prose(seed, n):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghiklmnorstuvé") for _ in range(r.randint(2, 9))) for _ in range(400)]
    return " ".join(r.choice(vocabulary) + r.choice(["", "", "", ",", ".\n"]) for _ in range(n))


def edge_texts():
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join(words[:150] + ["changed"] + words[151:])
    return [
        (1, base), (2, base), (3, near), (4, prose(2, 200)), (5, None), (6, ""), (7, " \n\t "), (8, "one two three"),
        (9, "x" * 30_000), (10, "ab " * 20_000), (11, prose(3, 60)), (11, prose(3, 60)), (None, prose(4, 50)),
        (None, None), (12, "日本語のテキスト " * 40 + "\U0001f600"), (13, "a▁b  c   d\n\ne "), (14, prose(5, 12_000)),
        (15, prose(6, 80) + " " + " ".join(words[:120])), (16, 'api_key = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72" x'),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", f"src{k % 7}" if k % 5 else None, len(t) if t is not None else None, *["clash"] * 14)
            for k, (i, t) in enumerate(edge_texts())]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
