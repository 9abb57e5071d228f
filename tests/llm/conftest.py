import pytest
from pyspark.sql import types as T

# names that the operators might use themselves
CLASHING = ("row", "t", "w", "h", "id", "k", "n", "c", "piece", "bucket", "quality", "features", "pattern", "dedup", "mix",
            "fingerprint", "component_id", "row_hash", "size", "copies", "lines", "hashes", "ends", "gone", "key", "label", "p", "u", "v", "component", "smallest", "least", "class_print")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, source[, lang]]) as a documents table, on request with clashing columns."""

    def make(rows, clashing=False):
        fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                  T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
        full = []
        for r in rows:
            i, text, source, lang = (*r, *([None] * (4 - len(r))))
            full.append((i, text, lang, source, None if text is None else len(text)))
        if clashing:
            fields += [T.StructField(c, T.StringType()) for c in CLASHING]
            full = [(*r, *[None if j % 2 else c for j, c in enumerate(CLASHING)]) for r in full]
        return spark.createDataFrame(full, T.StructType(fields))

    return make


LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
#: null id, null and empty texts, white space, a very long text, ties and repeated rows
ODD = [
    (None, "a text whose id is missing, long enough to count for something here", "s"), (1, None, "s"), (2, "", None), (3, " \t\n ", "s"),
    (4, LONG, "s"), (5, "one", None), (5, "one", None), (6, "same text twice\nin two lines", "z"), (7, "same text twice\nin two lines", "z"),
    (8, "Ünïcödé 日本 текст\n\nx", "ß"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
