import random

import pytest

from cases import smallest_reachable
from ledgerline.llm.graph import components


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    r = random.Random(seed)
    links = [(r.randint(0, 120), r.randint(0, 120)) for _ in range(90)]
    links += [(k, k + 1) for k in range(200, 240)] + [(300, k) for k in range(301, 400)] + [(7, 7)]
    got = {x["node"]: x["component"] for x in components(
        spark.createDataFrame([*links, (None, 5), (5, None)], "u long, v long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == smallest_reachable(linked, [x for x in links if x[0] != x[1]])


def test_no_links(spark):
    assert components(spark.createDataFrame([(3, 3)], "u long, v long")).collect() == []
