"""Rows that every operator must take: nulls, empty and long texts, repeats, clashing names."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 4000
TEXTS = [
    None, "", " ", "\n\t \n", "one", "two words", "a  b   c ", "x<|endoftext|>y", "日本語 テスト 🎉", "é é ﬁ   　 ß İ",
    "The same line.\nThe same line.\nAnother one!", LONG, "1 2 3 4 5 6 7 8 9", "!!! ??? ...", "don't we'll I'M",
]


def documents(spark, texts=None, extra=True):
    """Documents with a null id, repeated rows, one id with two texts, and columns
    named like those the operators make."""
    texts = TEXTS if texts is None else texts
    rows = [(i, t) for i, t in enumerate(texts)]
    if texts is TEXTS:
        rows += [(None, "one null id"), (4, "one"), (5, "another text"), (None, None)]
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    if extra:
        names = ["lang", "ids", "score", "piece", "length", "offset", "sequence_id", "fp", "component_id", "chunk", "same", "kept"]
        fields += [T.StructField(n, T.StringType()) for n in names]
        rows = [(*r, "en", *[None] * (len(names) - 1)) for r in rows]
    return spark.createDataFrame(rows, T.StructType(fields))


def empty(spark):
    return documents(spark, [])
