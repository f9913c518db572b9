import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import common
from millrace.llm import minimax_shards as m


def brute_capacity(sizes, shards):
    """Least largest part over all contiguous partitions, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        nxt = list(best)
        for end in range(1, len(sizes) + 1):
            total = 0
            for start in range(end - 1, -1, -1):
                total += sizes[start]
                nxt[end] = min(nxt[end], max(best[start], total))
        best = nxt
    return best[-1]


def check_rows(rows, docs, shards):
    assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in docs)
    text = dict(docs)
    owner = {}
    for r in rows:
        t = text[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        assert owner.setdefault(t, r["shard"]) == r["shard"]
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_capacity_is_least(spark, make_docs):
    rng = random.Random(3)
    docs = [(i, rng.choice("abcdé") * rng.randint(0, 60) + str(rng.randint(0, 40))) for i in range(300)]
    rows = m.shard_by_bytes(make_docs(docs), 8).collect()
    check_rows(rows, docs, 8)
    keyed = m.sized(make_docs(docs)).groupBy("key").sum("size").orderBy("key").collect()
    loads = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(loads) == brute_capacity([r[1] for r in keyed], 8)


def test_cells_are_refined_to_the_exact_cut():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-2**63, 2**63 - 1, 4000))
    keys = np.unique(np.concatenate([keys, keys[0] + np.arange(3000)]))  # a crowded cell
    sizes = rng.integers(1, 500, len(keys))

    def read(depth, parents, above):
        out = {}
        for k, s in zip(keys.tolist(), sizes.tolist()):
            if parents is None or (k >> (64 - above)) in parents:
                out.setdefault(k >> (64 - depth), []).append((k, s))
        return [m.Cell(min(v)[0], depth, p, sum(s for _, s in v), len(v) == 1) for p, v in out.items()]

    cuts = m.cut_keys(read(m.STEP, None, 0), 8, read)
    shard = np.searchsorted(np.array(cuts), keys, "right")
    found = max(sizes[shard == s].sum() for s in range(8))
    ends, whole = np.cumsum(sizes), np.ones(len(sizes), bool)
    assert found == m.least_capacity(ends, whole, 8)


def test_group_above_its_share(make_docs):
    docs = [(i, "same text " * 30) for i in range(60)] + [(100 + i, f"text number {i} " * 5) for i in range(140)]
    rows = m.shard_by_bytes(make_docs(docs), 8).collect()
    check_rows(rows, docs, 8)
    loads = sorted(sum(r["size"] for r in rows if r["shard"] == s) for s in range(8))
    assert loads[0] > 0.8 * loads[-2]  # the others share evenly


def test_odd_rows(make_docs):
    docs = [(1, None), (2, ""), (3, "x" * 200_000), (4, "x"), (5, "x")]
    check_rows(m.shard_by_bytes(make_docs(docs, ["size", "key", "shard", "slot"]), 8).collect(), docs, 8)
    repeated = m.shard_by_bytes(make_docs([(7, "a b")] * 9), 3).collect()
    assert sorted(r["slot"] for r in repeated) == list(range(9)) and len({r["shard"] for r in repeated}) == 1
    assert m.shard_by_bytes(make_docs([]), 8).collect() == []
    assert m.shard_by_bytes(make_docs([(None, "t"), (None, None)]), 2).count() == 2


def test_same_shards_from_other_layouts(make_docs):
    docs = [(i, f"t{i % 70}" * (i % 9)) for i in range(200)]
    one = {r["doc_id"]: r["shard"] for r in m.shard_by_bytes(make_docs(docs).coalesce(1)).collect()}
    other = {r["doc_id"]: r["shard"] for r in m.shard_by_bytes(make_docs(docs[::-1]).repartition(7)).collect()}
    assert one == other


def test_equal_rows_are_dealt_apart(spark, monkeypatch):
    """A null id with one text on all rows: numbered without a gap, in many deals."""
    monkeypatch.setattr(common, "ROWS_PER_DEAL", 20)
    rows = common.materialize(common.with_lanes(spark.range(1000).selectExpr("cast(null as long) AS doc_id", "7L AS key", "0 AS shard")), "rows")
    found = common.numbered(rows, [1000], "shard", ["doc_id", "key"], "slot")
    assert sorted(r["slot"] for r in found.collect()) == list(range(1000)) and found.columns == ["shard", "doc_id", "key", "slot"]
    deals = rows.groupBy(F.pmod(F.xxhash64("doc_id", "key", common.LANE), F.lit(50))).count().collect()
    assert len(deals) == 50 and max(r["count"] for r in deals) < 50
