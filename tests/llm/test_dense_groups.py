"""Near dedup where one group is dense: many blocks, common parts by matrix product, repeated ids; components at the edge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helio.llm import minhash


def brute_components(sets, percent=80):
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    return group


@pytest.mark.parametrize("share", [0.3, 1.0])
def test_common_parts_by_either_way(share):
    rng = np.random.default_rng(7)
    sets = [np.sort(rng.choice(3000, int(rng.integers(0, 400)), replace=False)).astype(np.int64) for _ in range(40)]
    left, right = np.arange(25), np.arange(25, 40)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(25), np.arange(15), indexing="ij"))
    pick = rng.random(len(i)) < share
    i, j = i[pick], j[pick]
    want = [len(set(sets[left[a]].tolist()) & set(sets[right[b]].tolist())) for a, b in zip(i, j)]
    assert minhash._common(sets, left, right, i, j).tolist() == want
    few = slice(0, 20)
    assert minhash._common(sets, left, right, i[few], j[few]).tolist() == want[few]


@pytest.mark.parametrize("block", [8, 64])
def test_blocks_find_every_link_between_components(spark, block):
    """Members of one cluster and of others, by blocks: their links and the components they come with join what all pairs join."""
    rng = np.random.default_rng(block)
    base = rng.choice(10_000, 100, replace=False)
    sets = []
    for _ in range(150):
        own = base.copy()
        at = rng.choice(100, int(rng.integers(0, 16)), replace=False)
        own[at] = 10_000 + rng.choice(10_000, len(at), replace=False)
        sets.append(set(own.tolist()))
    words = [" ".join(f"w{x}" for x in sorted(s)) for s in sets]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    rows = minhash.signatures(docs, 1, "doc_id", "text")
    sketches = rows.select(F.col("doc").alias("node"), F.col("n_shingles").alias("n"), "sketch").cache()
    full = minhash._sets(minhash._texts(docs, "doc_id", "text").withColumn("node", F.col("doc")), 1).cache()
    component = [0 if k < 90 else k for k in range(150)]
    members = spark.createDataFrame([(0, k, component[k]) for k in range(150)], "cluster long, node long, component long")
    links = minhash._block_links(members, sketches, full, 80, block).collect()
    exact = {r["doc_id"]: r["component_id"] for r in minhash.near_dedup(docs, width=1).collect()}
    want = brute_components(sets)
    assert exact == dict(enumerate(want))
    group = list(component)
    for r in links:
        if group[r["a"]] != group[r["b"]]:
            lo, hi = sorted((group[r["a"]], group[r["b"]]))
            group = [lo if g == hi else g for g in group]
    pairs = [(i, j) for i in range(150) for j in range(i) if component[i] != component[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert pairs and all(group[i] == group[j] for i, j in pairs)


def test_a_dense_group_of_many_against_brute_force(spark):
    rng = np.random.default_rng(21)
    texts = []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(70)]
        for _ in range(520 if family == 0 else 60):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, 70))] = f"x{int(rng.integers(0, 6))}"
            texts.append(" ".join(own))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)})
    distinct = {}
    for k, s in enumerate(sets):
        distinct.setdefault(frozenset(s), []).append(k)
    heads = [v[0] for v in distinct.values()]
    group = brute_components([sets[k] for k in heads])
    want = {}
    for v, g in zip(distinct.values(), group):
        want |= dict.fromkeys(v, heads[g])
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_dedup(rows, width=4).collect()} == want
