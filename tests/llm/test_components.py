import random

from tidemart.llm.components import components
from tidemart.session import Scratch


def test_components_of_paths_stars_and_chance(spark):
    r = random.Random(4)
    path = list(range(40))
    r.shuffle(path)
    edges = list(zip(path, path[1:])) + [(100, k) for k in range(101, 130)]
    edges += [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)]
    edges = [e for e in edges if e[0] != e[1]]
    given = [*edges, (300, 300), *edges[:5]]
    with Scratch(spark, "test") as scratch:
        rows = components(spark.createDataFrame([*given, (None, 1), (1, None)], "a long, b long"), scratch)
        got = {x.node: x.component for x in rows.collect()}
        assert rows.count() == len(got)
    expected, changed = {n: n for e in edges for n in e}, True
    while changed:
        changed = False
        for a, b in edges:
            low = min(expected[a], expected[b])
            if expected[a] != low or expected[b] != low:
                expected[a] = expected[b] = low
                changed = True
    assert got == expected


def test_no_edges(spark):
    with Scratch(spark, "test") as scratch:
        assert components(spark.createDataFrame([], "a string, b string"), scratch).count() == 0
