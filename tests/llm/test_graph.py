import random

from meterlake.llm import graph, scratch


def chain(spark, nodes, text=False):
    """One path over shuffled numbers, and a pair beside it."""
    order = list(range(nodes))
    random.Random(3).shuffle(order)
    name = (lambda i: f"n{i:06d}") if text else int
    edges = [(name(a), name(b)) for a, b in zip(order, order[1:])] + [(name(nodes), name(nodes + 1))]
    kind = "string" if text else "long"
    want = {name(i): name(0) for i in range(nodes)} | {name(nodes): name(nodes), name(nodes + 1): name(nodes)}
    return spark.createDataFrame(edges, f"a {kind}, b {kind}"), want


def test_long_chains(spark):
    for text in (False, True):
        edges, want = chain(spark, 400, text)
        rows = graph.components(edges).collect()
        assert len(rows) == len(want) and {r["node"]: r["component"] for r in rows} == want


def test_no_plan_grows_with_the_rounds(spark, monkeypatch):
    """The driver plans and broadcasts a few joins at a time, however many rounds a chain takes."""
    joins, rounds = [], []
    write = scratch.write

    def seen(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        rounds.append(name == "moves")
        return write(df, name)

    monkeypatch.setattr(graph.scratch, "write", seen)
    edges, want = chain(spark, 1500)
    assert graph.components(edges).count() == len(want)
    assert sum(rounds) > graph.FOLD + 1 and max(joins) <= graph.FOLD


def test_what_is_stored_is_dropped(spark, monkeypatch):
    kept = {}
    write, drop = scratch.write, scratch.drop

    def put(df, name):
        out = write(df, name)
        kept[out._scratch_path] = name
        return out

    def gone(*tables):
        drop(*tables)
        for t in tables:
            kept.pop(getattr(t, "_scratch_path", None), None)

    monkeypatch.setattr(graph.scratch, "write", put)
    monkeypatch.setattr(graph.scratch, "drop", gone)
    edges, want = chain(spark, 300)
    assert graph.components(edges).count() == len(want)
    assert list(kept.values()) == ["components"]


def test_no_edges(spark):
    out = graph.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"))
    assert out.columns == ["node", "component"] and out.count() == 0
