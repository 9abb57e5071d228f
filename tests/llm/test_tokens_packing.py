import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from layerkit.llm import packing
from layerkit.llm.tokens import TextEncoder, public_tokenizer

BYTES, WORDS = public_tokenizer("byte_bpe_50k.json"), public_tokenizer("word_bpe_49k.json")
ENCODERS = {p: TextEncoder(p, keep=50) for p in (BYTES, WORDS)}
WORDS_AND_GAPS = st.lists(st.sampled_from([
    "the", "don't", "I'LL", " it's", "café", "A.B", "x'y", "\n", "\n\n", " \n", "3.14", "²", "—", "’s", "…", "日本", " ", "İ", "a\tb",
]), max_size=12).map("".join)
TEXTS = WORDS_AND_GAPS | st.text(st.sampled_from("abcZ é ñß'\n\t  .,!0123<|>_-日　̈"), max_size=60) | st.text(max_size=40)


@given(st.lists(TEXTS, max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_library(texts):
    for e in ENCODERS.values():
        plain = [np.asarray(e.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert e.encode(texts) == plain


def test_special_strings_and_null():
    for e in ENCODERS.values():
        got = e.encode([None, "", "<|endoftext|> x<|endoftext|>"])
        assert got[0] == got[1] == b""
        assert max(np.frombuffer(got[2], "<u4")) < 49406


def brute_place(lengths, cap):
    """Try every open sequence and take the smallest sum of squared counts, then the smallest gap."""
    bins, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        s, best = lengths[i], None
        for gap in sorted({b for b in bins if b >= s}):
            left = list(bins)
            left[left.index(gap)] = gap - s
            cost = sum(n * n for g, n in zip(*np.unique([b for b in left if b], return_counts=True))) if any(left) else 0
            if best is None or cost < best[0]:
                best = (cost, gap)
        if best is None:
            bins.append(cap - s)
            out[i] = cap
        else:
            bins[bins.index(best[1])] = best[1] - s
            out[i] = best[1]
    return sorted(bins), out


@given(st.lists(st.integers(1, 20), max_size=25))
@settings(max_examples=100, deadline=None)
def test_place_is_sum_of_squares(lengths):
    seq, offset = packing.place(np.array(lengths, np.int64), 20)
    gaps, chosen = brute_place(lengths, 20)
    assert [20 - int(o) for o in offset] == [chosen[i] for i in range(len(lengths))]
    fill = np.bincount(seq, weights=lengths, minlength=len(gaps)) if lengths else np.array([])
    assert sorted(20 - fill) == gaps


def test_pieces_and_pack(spark, make_docs, odd):
    docs = make_docs(odd, clashing=True)
    pieces = packing.token_pieces(docs, BYTES, seq_len=256)
    rows = packing.pack(pieces, seq_len=256, per_bucket=64).collect()
    tok = ENCODERS[BYTES].tok
    want = sorted((str(i), len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t, *_ in odd)
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.start, r.piece), []).append(r)
    got = {}
    for r in rows:
        got[str(r.doc_id)] = got.get(str(r.doc_id), 0) + r.length
    total = {}
    for i, n in want:
        total[i] = total.get(i, 0) + n
    assert got == total
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length <= 256 and (r.piece == 0 or r.length == 256)
    long_doc = sorted((r for r in rows if r.doc_id == 4), key=lambda r: r.piece)
    joined = b"".join(bytes(r.ids) for r in long_doc)
    assert joined == np.asarray([*tok.encode(odd[4][1], add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert [r.start for r in long_doc] == list(np.cumsum([0] + [r.length for r in long_doc])[:-1])
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256


def test_pack_is_near_the_bound_and_whole(spark):
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 2048)
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long").repartition(7)
    packed = packing.pack(df)
    assert packed.count() == 20_000
    n = packed.select("sequence_id").distinct().count()
    assert n <= 1.003 * -(-lengths.sum() // 2048)


def test_pack_empty_and_hot_rows(spark, make_docs):
    assert packing.pack(packing.token_pieces(make_docs([]), BYTES)).count() == 0
    copies = make_docs([(i, "the same words") for i in range(300)] + [(9, "the same words")] * 50)
    packed = packing.pack(packing.token_pieces(copies, BYTES)).collect()
    assert len(packed) == 350 and {zlib.crc32(bytes(r.ids)) for r in packed} == {zlib.crc32(bytes(packed[0].ids))}
