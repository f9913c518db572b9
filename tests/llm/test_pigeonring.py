import random

import numpy as np
import pytest
import xxhash

from millrace.llm import pigeonring as p
from millrace.llm.blocks import Joined, spanning_links
from millrace.llm import components as components_module
from millrace.llm.components import components


def brute_print(text, words=4):
    import re
    parts = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not parts:
        return 0
    shingles = [parts] if len(parts) < words else [parts[i:i + words] for i in range(len(parts) - words + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance):
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= distance:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in prints}


def near_texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(0, 300))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            near = list(base)
            for _ in range(rng.randint(0, 2)):
                if near:
                    near[rng.randrange(len(near))] = rng.choice(words)
            out.append("\t".join(near).upper())
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


def test_against_brute_force(make_docs):
    docs = near_texts(1) + [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "Ünïcode x Y"), (905, "a b c")]
    rows = {r["doc_id"]: r for r in p.near_duplicates(make_docs(docs, ["print", "key", "rep"])).collect()}
    prints = {i: brute_print(t) for i, t in docs}
    assert {i: r["fingerprint"] for i, r in rows.items()} == {i: f"{v:016x}" for i, v in prints.items()}
    assert {i: r["component_id"] for i, r in rows.items()} == brute_groups(prints, 4)


@pytest.mark.parametrize("heavy", [200, 3])
def test_links_lose_no_pair(spark, monkeypatch, heavy):
    """Clouds of fingerprints round a few centres, with every distance up to 6."""
    monkeypatch.setattr(p, "HEAVY", heavy)
    monkeypatch.setattr(p, "BLOCK", 16)
    rng = random.Random(heavy)
    prints = {}
    for c in range(12):
        centre = rng.getrandbits(64)
        for _ in range(20):
            value = centre
            for b in rng.sample(range(64), rng.randint(0, 6)):
                value ^= 1 << b
            if value not in prints.values():
                prints[len(prints)] = value
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in prints.items()]
    df = spark.createDataFrame(signed, "rep long, print long")
    found = {r["node"]: r["component"] for r in components(p.links(df, 4)).collect()}
    expected = brute_groups(prints, 4)
    assert {i: found.get(i, i) for i in prints} == expected


def test_links_of_a_group_grow_with_its_rows(spark):
    """180 near copies, fewer than the former limit of 200, each linked to each: far fewer links than pairs join them."""
    rng = random.Random(180)
    centre, prints = rng.getrandbits(63), set()
    while len(prints) < 180:
        value = centre
        for b in rng.sample(range(26, 63), 2):
            value ^= 1 << b
        prints.add(value)
    rows = p.links(spark.createDataFrame([(x, x) for x in prints], "rep long, print long"), 4).collect()
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows)).collect()}
    assert found == dict.fromkeys(prints, min(prints))
    assert len({(min(r["u"], r["v"]), max(r["u"], r["v"])) for r in rows}) < 20 * 180 < 180 * 179 // 2


def test_joined_tells_links_that_join_something(spark):
    rng = random.Random(6)
    u, v = ([rng.randint(0, 80) for _ in range(400)] for _ in range(2))
    for most in (1000, 20):
        joined = Joined(most)
        kept = [x for k in range(0, 400, 50) for x, new in zip(zip(u[k:], v[k:]), joined.new(u[k:k + 50], v[k:k + 50])) if new]
        assert len(kept) <= 80 or most == 20
        groups = []
        for links in (list(zip(u, v)), kept):
            group = {x: x for x in range(81)}
            for _ in range(81):
                for a, b in links:
                    group[a] = group[b] = min(group[a], group[b])
            groups.append(group)
        assert groups[0] == groups[1]


def test_odd_tables(make_docs):
    assert p.near_duplicates(make_docs([])).collect() == []
    rows = p.near_duplicates(make_docs([(5, "a b c d e")] * 3 + [(None, "a b c d e"), (6, "x" * 100_000)])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in rows) == [(0, 5), (5, 5), (5, 5), (5, 5), (6, 6)]


def test_long_chains_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (502, 500), (7, 7)], "u long, v long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500}


def test_spanning_links_join_what_the_matrix_joins():
    rng = np.random.default_rng(2)
    for _ in range(30):
        left, right = rng.permutation(60)[:12], rng.permutation(60)[:15]
        linked = rng.random((12, 15)) < 0.1
        u, v = spanning_links(linked, left, right)
        parent = {int(x): int(x) for x in [*left, *right]}

        def joined(pairs):
            label = dict(parent)
            for _ in range(80):
                for a, b in pairs:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        pairs = [(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(linked))]
        assert joined(pairs) == joined(list(zip(u.tolist(), v.tolist()))) and len(u) <= 27


def test_null_and_shared_ids_are_told_apart_by_their_texts(make_docs):
    rng = random.Random(8)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(200)] for _ in range(12)]
    texts = [" ".join(b) for b in base]
    near = " ".join(base[0][:-1] + ["changed"])
    rows = [(None, t) for t in texts[:6]] + [(None, near)] + [(5, t) for t in texts[6:]] + [(5, texts[6]), (3, texts[7]), (None, texts[8])]
    linked = brute_groups(dict(enumerate(brute_print(t) for _, t in rows)), 4)
    assert linked[6] == 0 and len(set(linked.values())) == 12
    df = make_docs(rows)
    kept = p.one_of_each(df).collect()
    groups = {t: linked[i] for i, (_, t) in enumerate(rows)}
    assert sorted(groups[r["text"]] for r in kept) == sorted(set(linked.values()))
    assert {r["text"]: r["doc_id"] for r in kept if r["doc_id"]} == {t: 3 if t == texts[7] else 5 for t in texts[6:]}
    found = p.near_duplicates(df).collect()
    assert len(found) == len(rows) and sum(r["component_id"] is None for r in found) == 7
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found if r["component_id"]) == [(0, 5), (3, 3), (5, 3)] + [(5, 5)] * 6


def test_few_links_settle_with_few_shuffles(spark):
    """A round of few links has fewer shuffles, each of which burdens the driver; the components are those of any number."""
    rng = random.Random(4)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    stars = [components_module.small_star(components_module.large_star(x, few), few) for x, few in ((edges, False), (edges.coalesce(1), True))]
    many, few = (x._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for x in stars)
    assert few < many
    group = {x: x for pair in pairs for x in pair}
    for _ in range(len(group)):
        for u, v in pairs:
            group[u] = group[v] = min(group[u], group[v])
    linked = {x for u, v in pairs for x in (u, v) if u != v}
    for few in (0, components_module.FEW):
        components_module.FEW, before = few, components_module.FEW
        try:
            found = {r["node"]: r["component"] for r in components(edges).collect()}
        finally:
            components_module.FEW = before
        assert found == {x: group[x] for x in linked}
