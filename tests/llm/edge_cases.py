"""A small table with every awkward row: nulls, blanks, long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import types as T

_rng = random.Random(7)


def prose(n, seed=None, line=12):
    r = random.Random(seed) if seed is not None else _rng
    words = ["".join(r.choice("abcdeéfgh ")[:1] for _ in range(r.randint(2, 7))).replace(" ", "x") for _ in range(n)]
    return "".join(w + ("\n" if i % line == line - 1 else " ") for i, w in enumerate(words)).strip()


LONG = prose(3000, 1)
SHARED = prose(80, 2)
NEAR = LONG.split(" ")
NEAR[100] = "changed"
NEAR = " ".join(NEAR)

ROWS = [
    (None, "a text without an id " + prose(60, 3)),
    (1, None), (2, ""), (3, " \n\t \r\n"), (4, "three short words"), (5, "Three SHORT words"),
    (6, LONG), (7, LONG), (7, LONG), (8, NEAR), (9, NEAR.upper().replace("É", "é")),
    (10, prose(40, 4) + "\n" + SHARED + "\n" + prose(50, 5)), (11, SHARED), (12, prose(30, 6) + " " + SHARED),
    (13, "word " * 500), (14, "x" * 5000), (15, "日本語 テキスト 😀 <|endoftext|>   naïve" + prose(30, 8)),
    (16, SHARED + "\n\n" + SHARED), (17, "l1 a\nl2 b\nl3 c\nl4 d\n\nl1 a\nl2 b\nl3 c\r\nl5 e"),
    (18, "Released under the MIT License.\n" + prose(70, 9)), (19, "tab\tvertical\x0bform\x0cfeed\x1cunit\x85next"),
    (20, "l1 a\nl2 b\nl3 c\nnew line"),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns that an operator might use for itself
    *[T.StructField(c, T.StringType()) for c in ("row", "id", "key", "chunk", "n", "ids", "docs", "lines", "_x0", "gone")],
])


def documents(spark, rows=ROWS, partitions=3):
    data = [(i, t, "en", None if k % 4 == 0 else "host", len(t or ""), *["clash"] * 10) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()
