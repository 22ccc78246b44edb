import random

from lakeledger.llm.components import components
from lakeledger.llm.util import prepare


def brute(edges):
    low = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if a in low and b in low and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                moved = True
    return sorted(low.items())


def test_components_equal_brute_force(spark):
    prepare(spark)
    rnd = random.Random(4)
    graphs = [[], [(1, 1), (2, None), (None, 3)], [(1, 2)], [(i, i + 1) for i in range(60)],
              [(0, i) for i in range(1, 40)], [(100, i) for i in range(40)], [(3, 1), (3, 2), (1, 3)],
              [(rnd.randrange(-30, 60), rnd.randrange(60)) for _ in range(50)],
              [(2 * i, 2 * i + 1) for i in range(20)]]
    for edges in graphs:
        df = spark.createDataFrame(edges, "a long, b long")
        assert sorted((r.node, r.component) for r in components(df).collect()) == brute(edges), edges
