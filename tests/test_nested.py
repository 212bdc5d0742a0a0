"""Hierarchies and JSON cells written by hand."""

import pytest

from tidemark.operators import hierarchy, json_cells


def test_closure_of_a_tree_with_odd_edges(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (2, 3), (3, 4), (1, 4), (None, 1), (5, None)], "parent int, child int")
    got = {(r["ancestor"], r["descendant"]): r["depth"] for r in hierarchy.closure(edges).collect()}
    assert got == {(1, 2): 1, (2, 3): 1, (3, 4): 1, (1, 4): 1, (1, 3): 2, (2, 4): 2}
    values = spark.createDataFrame([(4, 10), (4, 5), (3, 1), (9, 7), (None, 3), (2, None)], "node int, v int")
    totals = {r["node"]: r["v"] for r in hierarchy.rolled_up(hierarchy.closure(edges), values, "node", ["v"]).collect()}
    assert totals == {4: 15, 3: 16, 2: 16, 1: 16, 9: 7}


def test_cycles_end_and_are_named(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "e")], "parent string, child string")
    pairs = hierarchy.closure(edges)
    assert {(r["node"], r["length"]) for r in hierarchy.cycle_nodes(pairs).collect()} == {("a", 3), ("b", 3), ("c", 3), ("e", 1)}
    totals = hierarchy.rolled_up(pairs, spark.createDataFrame([("a", 1), ("b", 2), ("c", 4), ("d", 8)], "node string, v int"), "node", ["v"])
    assert {r["node"]: r["v"] for r in totals.collect()} == {"a": 15, "b": 15, "c": 15, "d": 8}
    nothing = spark.createDataFrame([], "parent string, child string")
    assert hierarchy.closure(nothing).count() == 0


CELLS = [
    '{"a": 1, "b": {"c": "x", "d": [1, 2.5]}, "e": 1}', '{"a": "q", "b": null, "e": 2.25}', "{bad", None, "[1]", "7", '{"e": 1e3, "z": true}',
    '{"a": 1, "a": 2}', '{"b": {"c": 5}, "it\'s": 3, "n": null}', "{}", '{"big": 123456789012345678901234567890}',
    '{"big": 0.123456789012345678901234567890}', '{"x.y": {"": 4}}',
]


def test_types_of_paths(spark):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(CELLS)], "id int, cell string")
    found = {".".join(r["path"]): (r["type"], r["n_filled"], r["n_null"], r["mixed"]) for r in json_cells.infer_json(rows, "cell").collect()}
    assert found == {
        "a": ("string", 2, 0, True), "b": ("object", 2, 1, False), "b.c": ("string", 2, 0, True), "b.d": ("string", 1, 0, False),
        "e": ("double", 3, 0, False), "z": ("boolean", 1, 0, False), "it's": ("bigint", 1, 0, False), "n": ("string", 0, 1, False),
        "big": ("double", 2, 0, False), "x.y": ("object", 1, 0, False), "x.y.": ("bigint", 1, 0, False),
    }
    kinds = {r["kind"]: r["n"] for r in json_cells.type_counts(rows, "cell").where("size(path) = 0").collect()}
    assert kinds == {"OBJECT": 8, "BROKEN": 2, "MISSING": 1, "ARRAY": 1, "BIGINT": 1}
    cells = {r["id"]: r.asDict() for r in json_cells.shredded(rows, "cell", json_cells.infer_json(rows, "cell")).collect()}
    assert (cells[0]["a"], cells[0]["b.c"], cells[0]["b.d"], cells[0]["e"]) == ("1", "x", "[1,2.5]", 1.0)
    assert (cells[1]["a"], cells[8]["b.c"], cells[8]["it's"], cells[12]["x.y."]) == ("q", "5", 3, 4)
    assert [i for i in cells if cells[i]["is_broken"]] == [2, 7] and all(v is None for k, v in cells[4].items() if k not in ("id", "is_broken"))


def test_json_edges(spark):
    empty = spark.createDataFrame([], "id int, cell string")
    types = json_cells.infer_json(empty, "cell")
    assert types.count() == 0 and json_cells.shredded(empty, "cell", types).columns == ["id", "is_broken"]
    clash = spark.createDataFrame([(1, '{"id": 1}')], "id int, cell string")
    with pytest.raises(ValueError, match="twice"):
        json_cells.shredded(clash, "cell", json_cells.infer_json(clash, "cell"))
    deep = spark.createDataFrame([('{"a": {"b": {"c": 1}}}',)], "cell string")
    found = lambda n: {".".join(r["path"]): r["type"] for r in json_cells.infer_json(deep, "cell", n).collect()}
    assert found(1) == {"a": "string"} and found(2) == {"a": "object", "a.b": "string"}
    assert found(3) == found(8) == {"a": "object", "a.b": "object", "a.b.c": "bigint"}
    cut = json_cells.shredded(deep, "cell", json_cells.infer_json(deep, "cell", 2)).first()
    assert cut["a.b"] == '{"c":1}'
