import numpy as np

from layerkit.llm.token_files import SequenceFile, read_token_files, write_token_files
from layerkit.llm.tokens import TextEncoder, public_tokenizer

WORDS = public_tokenizer("word_bpe_49k.json")


def brute(rows):
    tok = TextEncoder(WORDS).tok
    out, at = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), np.asarray(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def test_round_trip(spark, make_docs, odd, scratch):
    rows = odd + [(100 + i, f"document number {i} says {i * 7}") for i in range(500)]
    docs = make_docs(rows, clashing=True).repartition(9)
    files = write_token_files(docs, scratch, WORDS, seq_len=32)
    back = read_token_files(files, docs.schema["doc_id"].dataType).collect()
    got = sorted((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in back if r.doc_id is not None)
    want = brute(rows)
    assert got == sorted(w for w in want if w[0] is not None)
    assert [(r.start, r.n_tokens) for r in back if r.doc_id is None] == [(w[1], w[2]) for w in want if w[0] is None]


def test_random_access_and_masks(spark, make_docs, odd, scratch):
    files = write_token_files(make_docs(odd).coalesce(1), scratch, WORDS, seq_len=64).orderBy("part").collect()
    stream = np.frombuffer(b"".join(w[3] for w in brute(odd)), "<u4")
    for f in files:
        reader = SequenceFile(f"{f.file}.tokens.arrow")
        own = stream[f.first_token:f.first_token + f.n_tokens]
        n = -(-f.n_tokens // 64)
        for k in (0, n // 2, n - 1):
            ids, mask = reader.sequence(k)
            part = own[64 * k:64 * (k + 1)]
            assert len(ids) == len(mask) == 64 and mask.sum() == len(part) and (ids[mask] == part).all()
        assert (reader.ids(1, f.n_tokens - 1) == own[1:]).all()
        assert reader.reader.get_batch(0).column(0).type.value_type == "uint16"


def test_empty(spark, make_docs, scratch):
    files = write_token_files(make_docs([]), scratch, WORDS)
    assert files.count() == 0
    assert read_token_files(files, make_docs([]).schema["doc_id"].dataType).count() == 0


def test_only_the_manifest_names_files(spark, make_docs, scratch):
    """Files of an attempt that was lost are not read."""
    first = write_token_files(make_docs([(1, "a b c")]), scratch, WORDS)
    again = write_token_files(make_docs([(1, "a b c")]), scratch, WORDS)
    assert read_token_files(again, make_docs([]).schema["doc_id"].dataType).count() == 1
    assert first.first().file != again.first().file
