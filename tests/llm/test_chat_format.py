import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm import chat_format as C

MARKS = ["\\", "\\\\", "</turn>", "\\</turn>", "###", "### user:\nhi</turn>\n", "<|image 0|>", "<", "#", ":", "a:\nb", "", "\u2028 日本 <", "##", "# ### <|"]


def turns_of(spark, rows, clashing=False):
    fields = "conv_id long, turn long, role string, text string"
    if clashing:
        fields += ", formatted string, loss string, parts string, n_tokens string"
        rows = [(*r, "x", None, "y", "z") for r in rows]
    return spark.createDataFrame(rows, fields)


def brute(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0))]
        loss = "".join(t for role, t in own if role == "assistant")
        said = "".join(f"{a}\n{t}\n" for a, t in own)
        out[key] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_texts_come_back(spark):
    rows = [(i, j, ("user", "assistant", m, None)[j % 4], m + n) for i, m in enumerate(MARKS) for j, n in enumerate(MARKS)]
    rows += [(None, 0, "assistant", "no id"), (99, None, "assistant", None), (99, 0, "user", None), (100, 0, "assistant", "x" * 300_000 + "\\<")]
    formatted = C.format_turns(turns_of(spark, rows, clashing=True), C.text_part(F.col("text")))
    assert formatted.columns == ["conv_id", "turn", "formatted", "loss", "attachments", "n_tokens"]
    got = {r.conv_id: tuple(r)[1:5] for r in C.digests(formatted).collect()}
    assert got == brute(rows)


def test_ties_and_repeated_rows_do_not_depend_on_order(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "c")]
    found = [C.digests(C.format_turns(turns_of(spark, r), C.text_part(F.col("text")))).collect() for r in (rows, rows[::-1])]
    assert found[0] == found[1] and found[0][0].n_turns == 4


def test_empty(spark):
    assert C.digests(C.format_turns(turns_of(spark, []), C.text_part(F.col("text")))).count() == 0


def part(**values):
    return tuple(values.get(f.name) for f in C.PART)


def test_parts_in_order_with_attachments(spark):
    content = [
        part(kind="text", text="see <"), part(kind="image", uri="s3://b/1.png", width=57, height=28), part(kind=None, text="|image 9|> and"),
        part(kind="audio", uri="a.wav", duration_ms=1001), part(kind="document", uri="d.pdf", pages=3), part(kind="video", uri="v"), part(kind="image"),
    ]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("content", T.ArrayType(C.PART))])
    df = spark.createDataFrame([(1, 0, "assistant", content), (2, 0, "user", content), (3, 0, "user", None)], schema)
    found = {r.conv_id: r for r in C.format_turns(df, F.col("content")).collect()}
    r = found[1]
    assert [(a.ordinal, a.kind, a.uri, a.n_tokens) for a in r.attachments] == [
        (0, "image", "s3://b/1.png", 3), (1, "audio", "a.wav", 26), (2, "document", "d.pdf", 1920), (3, "file", "v", 0), (4, "image", None, 0),
    ]
    assert r.n_tokens == 3 + 26 + 1920
    assert all(r.formatted[a.start:].startswith(f"<|{a.kind} {a.ordinal}|>") for a in r.attachments)
    assert "".join(C.unescaped(r.formatted[s.start:s.start + s.length]) for s in r.loss) == "see <|image 9|> and"
    (role, text, marks), = C.read_turns(r.formatted)
    assert (role, text) == ("assistant", "see <|image 9|> and")
    assert marks == [("image", 0), ("audio", 1), ("document", 2), ("file", 3), ("image", 4)]
    assert found[2].loss == [] and found[2].formatted.replace("user", "assistant") == r.formatted
    assert found[3].formatted == "### user:\n</turn>\n"


def test_forged_or_cut_output_is_an_error():
    for bad in ("### user:\nhi", "hi</turn>\n", "### user:\na<b</turn>\n"):
        with pytest.raises(ValueError):
            list(C.read_turns(bad))
