import random
import zlib
from collections import defaultdict

from layerkit.llm import kd_shards as K


def check(rows, got, n):
    assert len(got) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))
    size = defaultdict(int)
    for r in got:
        size[r.shard] += r.size
    return size


def corpus(n, seed=1):
    r = random.Random(seed)
    return [(i, "".join(r.choice("abc é") for _ in range(int(100 * r.paretovariate(1.5)) % 5000)), f"s{r.randint(0, 9) ** 2 % 7}", r.choice(["en", "de", None]))
            for i in range(n)]


def test_shards_are_even_and_groups_whole(make_docs):
    rows = corpus(6000)
    rows += [(10_000 + i, "copied text " * 9, f"s{i % 5}", "en") for i in range(150)]
    got = K.shards(make_docs(rows, clashing=True), 16).collect()
    size = check(rows, got, 16)
    mean = sum(size.values()) / 16
    largest = max(r.size for r in got)
    assert len(size) == 16 and all(abs(s - mean) <= max(0.02 * mean, 2 * largest) for s in size.values())
    assert len({r.shard for r in got if r.doc_id >= 10_000}) == 1


def test_a_group_of_a_third_is_divided(make_docs):
    rows = corpus(2000, 2)
    total = sum(len(t) for _, t, *_ in rows)
    rows += [(10_000 + i, "x" * 200, "s", "en") for i in range(total // 400)]
    size = check(rows, K.shards(make_docs(rows), 8).collect(), 8)
    mean = sum(size.values()) / 8
    assert all(abs(s - mean) < 0.08 * mean for s in size.values())


def test_target_bytes_and_odd_counts(make_docs):
    rows = corpus(1500, 3)
    total = sum(len((t or "").encode()) + 1 for _, t, *_ in rows)
    size = check(rows, K.shards(make_docs(rows), target_bytes=total // 5).collect(), 5)
    assert len(size) == 5 and max(size.values()) < 1.25 * min(size.values())


def test_same_shards_on_every_run(make_docs):
    rows = corpus(500, 4)
    runs = [sorted((r.doc_id, r.shard, r.slot) for r in K.shards(make_docs(rows).repartition(p), 4).collect()) for p in (1, 7)]
    assert runs[0] == runs[1]


def test_odd_rows_and_empty_table(make_docs, odd):
    check(odd, K.shards(make_docs(odd, clashing=True), 4).collect(), 4)
    assert K.shards(make_docs([]), 16).count() == 0


def test_one_group_over_many_shards(make_docs):
    """256 parts would be four to a shard here."""
    rows = [(i, "x" * 200, "s", "en") for i in range(20_000)]
    size = check(rows, K.shards(make_docs(rows), 64).collect(), 64)
    mean = sum(size.values()) / 64
    assert len(size) == 64 and all(abs(s - mean) < 0.04 * mean for s in size.values())
    assert [K._part_bits(n) for n in (1, 16, 17, 768, 4096)] == [8, 8, 11, 16, 18]
