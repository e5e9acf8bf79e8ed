"""Connected components against union-find, and the rows that their joins make."""

import random

from docloom.llm.common import components


def band_edges(rng, nodes, bands=24, groups=20):
    """Edges as bands propose them: in each band every node is linked to the least of its group."""
    out = []
    for _ in range(bands):
        dealt = [[] for _ in range(groups)]
        for x in nodes:
            dealt[rng.randrange(groups)].append(x)
        out += [(min(g), x) for g in dealt if g for x in g if x != min(g)]
    return out


def chain(nodes):
    return list(zip(nodes, nodes[1:]))


def brute_roots(edges):
    parent = {x: x for a, b in edges if a != b for x in (a, b)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {x: root(x) for x in parent}


def joined_rows(spark, since=-1):
    """Rows that joins made in the executions after number `since`, and the number of the last one."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    each = lambda seq: (seq.apply(i) for i in range(seq.size()))
    rows, last = 0, since
    for at in (e.executionId() for e in each(store.executionsList())):
        if at > since:
            last, values = max(last, at), store.executionMetrics(at)
            joins = [n for n in each(store.planGraph(at).allNodes()) if "Join" in n.name()]
            got = [values.get(m.accumulatorId()) for n in joins for m in each(n.metrics()) if m.name() == "number of output rows"]
            rows += sum(int(v.get().replace(",", "")) for v in got if v.isDefined())
    return rows, last


def test_components_of_odd_graphs_equal_union_find(spark):
    rng = random.Random(11)
    shuffled = rng.sample(range(300, 400), 100)
    edges = chain(range(100)) + chain(range(200, 100, -1)) + chain(shuffled)
    edges += [(499, x) for x in range(400, 499)] + [(500, x) for x in range(501, 600)]  # hubs with the largest and the least number
    for k in range(30):  # hubs with large numbers, each shared by two least neighbours
        edges += [(700 + k, 600 + k), (601 + k, 700 + k)]
    edges += band_edges(rng, range(800, 900)) + [(rng.randrange(900, 1000), rng.randrange(900, 1000)) for _ in range(70)]
    edges += [(b, a) for a, b in edges[::3]] + edges[::5] + [(1, 1), (2000, 2000)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == brute_roots(edges) and len(got) == len({r.node for r in got})
    assert components(spark.createDataFrame([(7, 7)], "a long, b long")).collect() == []


def test_components_of_a_large_group_join_no_edge_again_that_is_done(spark):
    rng = random.Random(12)
    edges = list(set(band_edges(rng, range(1000)) + chain(rng.sample(range(2000, 2064), 64))))
    table = spark.createDataFrame(edges, "a long, b long")
    before = joined_rows(spark)[1]
    got = {r.node: r.root for r in components(table).collect()}
    rows = joined_rows(spark, before)[0]
    assert got == brute_roots(edges)
    assert 0 < rows < 4 * len(edges), (rows, len(edges))
