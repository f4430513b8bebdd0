import collections
import random
import zlib

from tests.llm.samples import ODD, table

from tidewatch.llm.sharding import shard_by_bytes, smallest_capacity


def test_capacity_is_the_smallest_that_suffices():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 12))]
        shards = rng.randint(1, 5)
        capacity, cuts = smallest_capacity(sizes, shards)
        parts = [sum(sizes[a:b]) for a, b in zip([0, *cuts], [*cuts, len(sizes)])]
        assert len(parts) <= shards and max(parts) == capacity or not sizes

        def best(sizes, shards):
            if shards == 1 or len(sizes) < 2:
                return sum(sizes)
            return min(max(sum(sizes[:k]), best(sizes[k:], shards - 1)) for k in range(1, len(sizes) + 1))

        assert capacity == best(sizes, shards)


def check(docs, got, shards):
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    slots = collections.defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows(odd, none):
    got = shard_by_bytes(odd, 4).collect()
    check(ODD, got, 4)
    assert len({r.shard for r in got if r.doc_id in (4, 10)}) == 1       # equal texts stay together
    assert shard_by_bytes(none, 4).count() == 0


def test_minimax_over_the_digests_order(spark, monkeypatch):
    import hashlib

    from tidewatch.llm import sharding
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)                       # so that it has to look closer
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    rng = random.Random(2)
    docs = [(i, "t" * rng.randint(0, 90) + str(rng.randrange(150))) for i in range(400)]
    got = shard_by_bytes(table(spark, docs), 7).collect()
    check(docs, got, 7)
    atoms = collections.Counter()
    for _, t in docs:
        atoms[hashlib.sha256(t.encode()).hexdigest()] += len(t) + 1
    load = collections.Counter()
    for r in got:
        load[r.shard] += r.size
    assert max(load.values()) == smallest_capacity([atoms[d] for d in sorted(atoms)], 7)[0]
