import random

import pytest

from vestibule.llm.components import components


def brute(links):
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return sorted((x, root(x)) for x in parent)


@pytest.mark.parametrize("seed", range(3))
def test_against_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(40)]
    links += [(100 + i, 101 + i) for i in range(25)]  # a path
    links += [(300, 300 + i) for i in range(1, 40)] * 2  # a star, twice
    links = [(a, b) for a, b in links if a != b]
    rng.shuffle(links)
    made = spark.createDataFrame(links, "a bigint, b bigint")
    assert sorted(map(tuple, components(made).collect())) == brute(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
    assert components(spark.createDataFrame([(4, 4)], "a bigint, b bigint")).collect() == []
