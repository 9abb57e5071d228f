import hashlib
import random
from collections import Counter

import pytest

from layerkit.llm import line_dedup as L

BLANK = " \t\x0b\x0c\r"


def units_of(text):
    """(line number, unit) of a text."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        if len(line) > L.LONG_LINE:
            for end in ".!?":
                line = line.replace(end + " ", end + " \0")
        out += [(i, u) for u in line.split("\0")]
    return out


def low_places(worded):
    """Places n whose rolled hash over units n and n + 1 is no strict maximum between its neighbours."""
    a = [int(hashlib.md5(u.encode()).hexdigest()[:8], 16) for _, u in worded]
    r = [L.MODULUS] + [(x * L.BASE + y) % L.MODULUS for x, y in zip(a, a[1:])] + [L.MODULUS]
    return [n - 1 for n in range(1, len(r) - 1) if r[n] <= r[n + 1] or r[n] < r[n - 1]]


def brute(rows):
    """Texts left, by id (distinct ids)."""
    texts = {i: units_of(t) for i, t in rows}
    worded = {i: [(j, u.strip(BLANK)) for j, (_, u) in enumerate(units) if u.strip(BLANK)] for i, units in texts.items()}
    low = {i: low_places(w) for i, w in worded.items()}

    def words(i, n, size):
        return tuple(u for _, u in worded[i][n:n + size])

    often = Counter(words(i, n, 2) for i in low for n in low[i])
    first, places = {}, set()
    for i in low:
        found = {n for n in low[i] if often[words(i, n, 2)] > 1}
        for n in found:
            places.add((i, n, 2))
            if n > 0 and not found & {n - 1, n - 2}:
                places.add((i, n - 1, 3))
            if n + 2 < len(worded[i]) and not found & {n + 1, n + 2}:
                places.add((i, n, 3))
    for i, n, size in sorted(places):
        first.setdefault(words(i, n, size), (i, n))
    gone = {i: set() for i in texts}
    for i, n, size in places:
        if first[words(i, n, size)] != (i, n):
            gone[i] |= set(range(worded[i][n][0], worded[i][n + size - 1][0] + 1))
    out = {}
    for i, t in rows:
        lines = {}
        for j, (line, u) in enumerate(texts[i]):
            if j not in gone[i]:
                lines.setdefault(line, []).append(u)
        out[i] = None if t is None else "\n".join("".join(us) for us in lines.values())
    return out


def corpus(seed, long_lines):
    r = random.Random(seed)
    lines = [f"line {i} " + "w" * (i % 5) for i in range(60)] + ["", " ", "L", "U", "X", "\t"]
    lines += [" ".join(f"Sentence {j} of {i} has many words in it{'.!?'[j % 3]}" for j in range(i % 9)) for i in range(long_lines)]
    passages = [[r.choice(lines) for _ in range(r.randint(2, 9))] for _ in range(12)]
    rows = []
    for i in range(300):
        body = [r.choice(lines) + str(r.random()) for _ in range(r.randint(0, 6))]
        for _ in range(r.randint(0, 3)):
            at = r.randint(0, len(body))
            body[at:at] = r.choice(passages)
        rows.append((i, "\n".join(body)))
    return rows


@pytest.mark.parametrize("long_lines", [0, 30])
def test_against_brute_force(make_docs, long_lines):
    rows = corpus(3, long_lines)
    got = {x.doc_id: x for x in L.remove_repeated_chunks(make_docs(rows, clashing=True)).collect()}
    assert {i: x.text for i, x in got.items()} == brute(rows)
    assert sum(len(x.text) for x in got.values()) < 0.85 * sum(len(t) for _, t in rows)
    for i, t in rows:
        assert got[i].dedup_.removed_words == len(t.split()) - len(got[i].text.split())


@pytest.mark.parametrize("n", [3, 5, 8, 12, 30, 100])
def test_shifted_passage_is_found(make_docs, n):
    passage = [f"sentence number {i} of a passage that many documents share" for i in range(n)]
    a, b = "\n".join(["own start"] + passage), "\n".join(["another", "longer", "start"] + passage + ["own end"])
    left = {x.doc_id: x for x in L.remove_repeated_chunks(make_docs([(1, a), (2, b)])).collect()}
    assert left[1].text == a and left[2].text == "another\nlonger\nstart\nown end"
    assert left[2].dedup.removed_lines == n and left[2].dedup.removed_words == 10 * n


def test_most_words_of_passages_go_in_any_context(make_docs):
    r = random.Random(9)
    rows, words, copies = [], 0, 12
    for p in range(60):
        passage = [f"passage {p} says in its unit {i} this and nothing else of {r.random()}" for i in range(r.randint(3, 6))]
        words += (copies - 1) * sum(len(x.split()) for x in passage)
        for c in range(copies):
            own = [f"own words of {p} {c} {j} {r.random()}" for j in range(r.randint(0, 6))]
            at = r.randint(0, len(own))
            rows.append((len(rows), "\n".join(own[:at] + passage + own[at:])))
    left = L.remove_repeated_chunks(make_docs(rows)).collect()
    assert sum(x.dedup.removed_words for x in left) >= 0.97 * words
    assert sum(x.text.count("own words") for x in left) == sum(t.count("own words") for _, t in rows)


def test_odd_rows(make_docs, odd):
    got = L.remove_repeated_chunks(make_docs(odd, clashing=True))
    assert set(make_docs(odd, clashing=True).columns) < set(got.columns)
    rows = got.collect()
    assert len(rows) == len(odd)
    text = {r.doc_id: r.text for r in rows}
    assert text[1] is None and text[2] == "" and text[3] == " \t\n " and text[4] == odd[4][1]
    assert text[6] == odd[7][1]


def test_rows_of_one_document_are_alike_and_empty_table(make_docs):
    twice = make_docs([(1, "a b\nc d\ne f\ng h\ni j"), (1, "a b\nc d\ne f\ng h\ni j")])
    assert len({r.text for r in L.remove_repeated_chunks(twice).collect()}) == 1
    assert L.remove_repeated_chunks(make_docs([])).count() == 0


def test_passage_of_a_long_line(make_docs):
    shared = " ".join(f"Shared sentence {i} stands in one long line of many words." for i in range(6))
    docs = make_docs([(1, f"Mine it is. {shared}"), (2, f"Yours it is. {shared} And its end.\nnext")])
    left = {x.doc_id: x.text for x in L.remove_repeated_chunks(docs).collect()}
    assert left[1] == f"Mine it is. {shared}"
    assert left[2] == "Yours it is. And its end.\nnext"


def test_units_are_cut_once_for_the_filter_and_the_chunks(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, None), (3, "a")], "k long, t string")
    plan = L._cut_chunks(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_join(") == 1
