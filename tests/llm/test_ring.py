import zlib
from collections import Counter

from claimweave.llm import ring
from claimweave.llm.base import table

FOLDER = "/root/testdata/sf0.001"


def test_counts_slots_and_digests(spark):
    docs = table(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = ring.shard_documents(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    counts = Counter(r.shard for r in rows)
    assert len(counts) == 40 and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    assert rows == ring.shard_documents(docs.repartition(5)).collect() or sorted(rows) == sorted(ring.shard_documents(docs.repartition(5)).collect())


def walk(cells_of, shards, virtual, cells):
    """Row by row: homes first, in ring order; then the rows left over go clockwise one by one."""
    nodes = ring.nodes(shards, virtual, cells)
    n = len(cells_of)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    home = lambda c: next((i for i, (at, _) in enumerate(nodes) if at >= c), 0)
    out, left = {}, []
    for k, c in sorted(cells_of.items(), key=lambda x: (x[1], x[0])):
        s = nodes[home(c)][1]
        if room[s]:
            room[s] -= 1
            out[k] = s
        else:
            left.append((k, home(c)))
    for k, i in left:
        while not room[nodes[i % len(nodes)][1]]:
            i += 1
        room[nodes[i % len(nodes)][1]] -= 1
        out[k] = nodes[i % len(nodes)][1]
    return out


def test_plan_equals_walking_row_by_row():
    cells_of = {k: (k * k * 7919) % 97 % 64 for k in range(500)}
    parts = ring.plan(Counter(cells_of.values()), 7, 3, 64)
    want = walk(cells_of, 7, 3, 64)
    rank = Counter()
    for k, c in sorted(cells_of.items(), key=lambda x: (x[1], x[0])):
        got = [s for cell, a, b, s, _ in parts if cell == c and a <= rank[c] < b]
        rank[c] += 1
        assert got == [want[k]]


def test_one_more_row_moves_few(spark):
    ids = spark.range(20000)
    from pyspark.sql import functions as F

    a = {r.id: r.shard for r in ring.ring_shards(ids, F.col("id"), ["id"]).collect()}
    b = {r.id: r.shard for r in ring.ring_shards(ids.filter("id <> 77"), F.col("id"), ["id"]).collect()}
    assert sum(a[k] != b[k] for k in b) < 200


def test_awkward_rows(spark, odd_docs, no_docs):
    rows = ring.shard_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count() and len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert ring.shard_documents(no_docs).count() == 0
    from pyspark.sql import functions as F

    out = ring.ring_shards(odd_docs, F.col("doc_id"), ["text"], shards=3)
    assert out.columns == [c for c in odd_docs.columns if c != "shard"] + ["shard", "slot"]
    assert sorted(Counter(r.shard for r in out.collect()).values()) == [4, 4, 4]
