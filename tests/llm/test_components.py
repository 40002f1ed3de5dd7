"""Connected components of links in any order."""

import random

from folioflow.llm.components import components

SCHEMA = "a long, b long"


def plain(links):
    up = {}

    def root(d):
        while up.setdefault(d, d) != d:
            d = up[d]
        return d

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {n: root(n) for n in list(up)}


def test_chain_of_random_ids_and_a_star(spark):
    r = random.Random(1)
    ids = r.sample(range(10**12), 2_000)
    links = [*zip(ids, ids[1:]), (5, 5), (7, 8), (8, 7), (7, 8), (-1, 10**13), *[(3, k) for k in range(10**14, 10**14 + 300)]]
    r.shuffle(links)
    got = {x.node: x.component for x in components(spark.createDataFrame(links, SCHEMA)).collect()}
    assert got == {n: c for n, c in plain(links).items() if n != 5}


def test_random_links(spark):
    r = random.Random(2)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(300)]
    assert {x.node: x.component for x in components(spark.createDataFrame(links, SCHEMA)).collect()} == plain(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], SCHEMA)).collect() == []
