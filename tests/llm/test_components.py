import random

from filanda.llm.components import connected_groups

SCHEMA = "source string, target string, weight double, node_id string"


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in parent}


def run(spark, links, w=None):
    return {r.node_id: r.group_id for r in connected_groups(spark.createDataFrame([(*x, "extra") for x in links], SCHEMA), w).collect()}


def test_dirt(spark):
    links = [(" A ", "b", 0.9), ("B", "a", 0.7), ("b", "c", 0.5), ("c", "d", 0.49), ("e", None, 1.0), ("f", "f", 1.0), ("g", "h", None), ("i", "j", float("nan")), ("", "k", 1.0), ("x", "Y", 0.8)]
    assert run(spark, links, 0.5) == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    assert run(spark, [], 0.5) == {}
    assert run(spark, [("a", "a", 1.0)]) == {}


def test_shapes(spark):
    rng = random.Random(4)
    chain = [(f"c{i:03}", f"c{i + 1:03}", 1.0) for i in range(60)]
    star = [("hub", f"s{i}", rng.random()) for i in range(80)]
    noise = [(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}", rng.choice([0.5, 0.5, 0.9])) for _ in range(30)]
    links = chain + star + noise + chain[:5]
    want = brute([(a, b) for a, b, _ in links if a != b])
    assert run(spark, links) == want
