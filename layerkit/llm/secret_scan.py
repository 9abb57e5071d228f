"""Secret scans: candidates by their characters, false positives removed by a random forest.

A candidate is a run of at least ``SHORTEST`` ASCII letters, digits and ``+/_-``, or, of any
length and make-up, the value that a credential word is given (up to its quote or white
space), a dotted JSON web token, or the password in a URL. A forest then tells secrets from long words, numbers and addresses by five kinds of features: length
and make-up of the run; how likely its character transitions are in the corpus; how much of it
dictionary words cover; the path (here the document's source) by hash; and the neighbouring
words (credential words, assignment and quotes before it, dictionary coverage on both sides).

It is trained from labelled findings. ``labelled`` makes them where no reviewed findings are
at hand, from evidence in the value that is no feature: a known key format is confirmed, a
placeholder or an identifier is a false positive, also where a credential word is given it. Of
the rest, a value of letters and digits given to a credential word is confirmed, a run without
digits amid ordinary words of the dictionary is a false positive, any other is not labelled. Training takes at most ``SAMPLE``
findings of each label (the lowest by hash); transitions and dictionary are counted over all
texts; every candidate is scored.

Scale: two passes over the texts, no shuffle of texts. What the tasks share is bounded: one
128 x 128 table of transitions and ``DICTIONARY`` words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stored

SHORTEST = 16
SAMPLE = 20_000
DICTIONARY = 4096
PATHS = 8  # hash cells of the path
TREES, DEPTH, SEED = 20, 6, 42
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}={{0,2}}")
WORDS = re.compile(r"(?<![a-z])[a-z]{3,6}(?![a-z])")
# fixed values: words that name a credential
CREDENTIAL = re.compile(r"(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth)\W*\Z", re.I)
# what a credential word is given; a JSON web token; user:password@ of a URL
VALUE = re.compile(
    r"(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth)(?![A-Za-z])[\w-]*"
    r"[\"']?[ \t]*(?::=|=>|==?|:)[ \t]*(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"']+))", re.I,
)
WEB_TOKEN = re.compile(r"(?<![\w-])eyJ[\w-]+\.[\w-]+\.[\w-]*", re.A)
IN_URL = re.compile(r"://[^\s/@:\"']{0,256}:([^\s/@\"']+)@")
# evidence for labels: formats of issued keys; placeholders; names
KEY_FORMAT = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w-]{20,}|sk-[\w-]{20,}|[sr]k_live_\w{16,}"
    r"|xox[abprs]-[\w-]{10,}|AIza[\w-]{35}|npm_[A-Za-z0-9]{36}|eyJ[\w-]+\.[\w-]+\.[\w-]*"
    r"|(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})", re.A,
)
DIGEST_BEFORE = re.compile(r"(?:commit|sha\d*|md5|checksum|digest|hash|revision)\W*\Z", re.I)
PLACEHOLDER = re.compile(
    r"(?i:.*(?:example|change_?me|replace|your[_-]|placeholder|dummy|redacted|insert|todo|<|\$\{|\{\{|%s|environ|getenv|process\.env).*"
    r"|(.)\1*|[x*.-]{3,}.*|(?:0?123456789?\d*|password|none|null|true|false)\W*)", re.S,
)
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z_.-]*(?:\([^()]*\))?[,;)]*")
ASSIGNED = re.compile(r"[=:]\s*[\"']?\Z")
FEATURES = (
    "length", "digits", "uppercase", "classes", "switches", "entropy", "transitions", "dictionary",
    "credential_before", "assigned", "quoted", "before_dictionary", "after_dictionary",
) + tuple(f"path_{i}" for i in range(PATHS))


def corpus_statistics(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, frozenset[str]]:
    """(log chance of each ASCII transition, dictionary), counted over all texts.

    The dictionary is the ``DICTIONARY`` most frequent words of 3 to 6 letters (ties by word)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, words = np.zeros(128 * 128, np.int64), Counter()

        def rows(kind: int, keys: list, counts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys, pa.string()), pa.array(counts, pa.int64())], names=["kind", "key", "n"],
            )

        for batch in batches:
            for t in batch.column(0):
                text = (t.as_py() or "").lower()
                raw = np.frombuffer(text.encode(), np.uint8).astype(np.int32)
                if len(raw) > 1:
                    a, b = raw[:-1], raw[1:]
                    ascii_only = (a < 128) & (b < 128)
                    seen += np.bincount(a[ascii_only] * 128 + b[ascii_only], minlength=128 * 128)
                words.update(WORDS.findall(text))
                if len(words) > 200_000:
                    yield rows(1, list(words), list(words.values()))
                    words = Counter()
        at = np.flatnonzero(seen)
        yield rows(0, [str(i) for i in at.tolist()], seen[at].tolist())
        yield rows(1, list(words), list(words.values()))

    counted = ship(docs.select(F.col(f"`{text_col}`").alias("t"))).mapInArrow(count, "kind int, key string, n long")
    totals = stored(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "secret-statistics")
    table = np.ones(128 * 128)
    for r in totals.filter("kind = 0").collect():  # at most 128 * 128 rows
        table[int(r["key"])] += r["n"]
    table = table.reshape(128, 128)
    top = totals.filter("kind = 1").orderBy(F.desc("n"), "key").limit(DICTIONARY).collect()
    return np.log(table / table.sum(1, keepdims=True)), frozenset(r["key"] for r in top)


def covered(word: str, dictionary: frozenset[str]) -> float:
    """Share of ``word`` covered by dictionary words, longest first from the left."""
    word, i, n = word.lower(), 0, 0
    while i < len(word):
        for size in (6, 5, 4, 3):
            if word[i:i + size] in dictionary and i + size <= len(word):
                i, n = i + size, n + size
                break
        else:
            i += 1
    return n / max(len(word), 1)


def features(text: str, start: int, end: int, log_chance: np.ndarray, dictionary: frozenset[str]) -> list[float]:
    """The numeric features of one candidate, without the path."""
    run = text[start:end]
    raw = np.frombuffer(run.lower().encode(), np.uint8)
    ascii_only = (raw[:-1] < 128) & (raw[1:] < 128)
    counts = np.bincount(raw)[np.unique(raw)] / len(raw)
    kinds = np.select([(raw >= 48) & (raw < 58), raw >= 97], [0, 1], 2)
    before, after = text[max(0, start - 40):start], text[end:end + 40]
    word_before, word_after = re.findall(r"\w+", before)[-1:], re.findall(r"\w+", after)[:1]
    return [
        float(len(run)),
        sum(c.isdigit() for c in run) / len(run),
        sum(c.isupper() for c in run) / len(run),
        float(len(set(kinds.tolist()))),
        float((kinds[1:] != kinds[:-1]).mean()) if len(raw) > 1 else 0.0,
        float(-(counts * np.log2(counts)).sum()),
        float(log_chance[raw[:-1][ascii_only], raw[1:][ascii_only]].mean()) if ascii_only.any() else 0.0,
        covered(run, dictionary),
        float(CREDENTIAL.search(before) is not None),
        float(ASSIGNED.search(before) is not None),
        float(before[-1:] in ("'", '"') and before != ""),
        covered(word_before[0], dictionary) if word_before else 0.0,
        covered(word_after[0], dictionary) if word_after else 0.0,
    ]


def spans(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, given to a credential word) of the candidates of a text, each span once."""
    found = {m.span(): False for m in CANDIDATE.finditer(text)}
    found |= {m.span(): False for m in WEB_TOKEN.finditer(text)}
    found |= {m.span(1): False for m in IN_URL.finditer(text)}
    found |= {m.span(m.lastindex): True for m in VALUE.finditer(text)}
    return [(a, b, named) for (a, b), named in sorted(found.items())]


def evidence(text: str, start: int, end: int) -> float | None:
    """1 for the format of an issued key, 0 for a placeholder, a name or a file's digest, else null."""
    value = text[start:end]
    if KEY_FORMAT.fullmatch(value):
        return 0.0 if DIGEST_BEFORE.search(text[max(0, start - 40):start]) else 1.0
    return 0.0 if PLACEHOLDER.fullmatch(value) or IDENTIFIER.fullmatch(value) else None


def candidates(
    docs: DataFrame, log_chance: np.ndarray, dictionary: frozenset[str], id_col: str = "doc_id",
    text_col: str = "text", path_col: str = "source",
) -> DataFrame:
    """(id_col, start, length, crc32, f, evidence): every candidate of every whole text with its features.

    ``start`` and ``length`` are code points. Null and empty texts have no candidate."""
    import zlib

    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("crc32", T.LongType()),
        T.StructField("f", T.ArrayType(T.DoubleType())), T.StructField("evidence", T.DoubleType()),
    ])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, crc, values, known = [], [], [], [], [], []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                path = zlib.crc32((batch.column(2)[i].as_py() or "").encode()) % PATHS
                one_hot = [float(p == path) for p in range(PATHS)]
                for a, b, named in spans(text):
                    row.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(text[a:b].encode()))
                    own = features(text, a, b, log_chance, dictionary)
                    if named:
                        own[FEATURES.index("credential_before")] = own[FEATURES.index("assigned")] = 1.0
                    values.append(own + one_hot)
                    known.append(evidence(text, a, b))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64()), pa.array(values, pa.list_(pa.float64())), pa.array(known, pa.float64())], names=schema.names,
            )

    read = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{path_col}`").cast("string").alias("p"))
    return ship(read).mapInArrow(find, schema)


def labelled(found: DataFrame) -> DataFrame:
    """Adds ``label``: 1 confirmed, 0 false positive, null unlabelled (see the module)."""
    f = {name: F.element_at("f", i + 1) for i, name in enumerate(FEATURES)}
    mixed = (f["digits"] > 0) & (f["classes"] > 1)
    confirmed = (f["credential_before"] == 1) & (f["assigned"] == 1) & mixed
    prose = ~mixed & (f["assigned"] == 0) & (f["quoted"] == 0) & (f["credential_before"] == 0) & (
        (f["before_dictionary"] > 0.5) | (f["after_dictionary"] > 0.5) | (f["dictionary"] > 0.3)
    )
    return found.withColumn("label", F.coalesce("evidence", F.when(confirmed, 1.0).when(prose, 0.0)))


def train(findings: DataFrame, sample: int = SAMPLE):
    """A forest from findings (f, label), or None unless both labels occur.

    Takes at most ``sample`` rows of each label, the lowest by a hash of the features."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    marked = findings.filter("label is not null").withColumn("h", F.xxhash64("f"))
    parts = [marked.filter(F.col("label") == y).orderBy("h").limit(sample).select("f", "label") for y in (0.0, 1.0)]
    taken = stored(parts[0].unionByName(parts[1]), "secret-training")
    if taken.select("label").distinct().count() < 2:
        return None
    # one partition: a bounded sample, and the same trees on every run
    vectors = taken.orderBy("label", "f").coalesce(1).select(array_to_vector("f").alias("features"), "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    return forest.fit(vectors)


def scored(found: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """Adds ``p_secret`` and ``secret``; without a model nothing is removed."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if model is None:
        return found.withColumn("p_secret", F.lit(1.0)).withColumn("secret", F.lit(True))
    judged = model.transform(found.withColumn("features", array_to_vector("f")))
    p = F.element_at(vector_to_array("probability"), 2)
    return judged.withColumn("p_secret", p).withColumn("secret", p >= threshold).select(*found.columns, "p_secret", "secret")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id_col, start, length, crc32, p_secret, secret): every candidate with its verdict.

    Null ids and paths are kept as they are, repeated rows have their findings each, other
    columns are left out; an empty table, or one without a candidate, gives an empty result.
    """
    log_chance, dictionary = corpus_statistics(docs, text_col)
    found = stored(candidates(docs, log_chance, dictionary, id_col, text_col, path_col), "secret-candidates")
    return scored(found, train(labelled(found))).drop("f", "evidence")
