"""The component tree and the stack of a sweep against labellings of each threshold alone."""

import random

import pytest

from canopyflow.operators import stack


def flood(cells):
    left, size = set(cells), {}
    while left:
        todo, seen = [left.pop()], []
        while todo:
            r, c = todo.pop()
            seen.append((r, c))
            for p in [(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]:
                if p in left:
                    left.remove(p)
                    todo.append(p)
        size |= dict.fromkeys(seen, len(seen))
    return size


@pytest.mark.parametrize("tile", [4, 7, 64])
def test_tree_equals_a_labelling_for_each_level(spark, tile):
    rng, levels = random.Random(tile), 4
    cells = {(k, r, c): rng.choices(range(levels + 1), [1, 2, 2, 2, 5])[0] for k in "ab" for r in range(-9, 21) for c in range(-6, 25)}
    rows = [(k, r, c, v) for (k, r, c), v in cells.items() if v < levels]
    got = {(x.k, x.r, x.c): x.sizes for x in stack.component_tree(spark.createDataFrame(rows, "k string, r int, c int, level int"), levels, ("k",), tile).collect()}
    want = {(k, r, c): [0] * levels for k, r, c, _ in rows}
    for level in range(levels):
        for k in "ab":
            for (r, c), n in flood([(r, c) for kk, r, c, v in rows if kk == k and v <= level]).items():
                want[k, r, c][level] = n
    assert got == want


def test_a_spiral_over_many_tiles_is_one_component(spark):
    r = c = 0
    path, (dr, dc), step = {(0, 0)}, (0, 1), 2
    while step < 40:
        for _ in range(2):
            for _ in range(step):
                r, c = r + dr, c + dc
                path.add((r, c))
            dr, dc = dc, -dr
        step += 2
    got = stack.component_tree(spark.createDataFrame([(*p, i % 2) for i, p in enumerate(sorted(path))], "r int, c int, level int"), 2, (), 5)
    assert {x.sizes[1] for x in got.collect()} == {len(path)}


def test_stack(spark):
    rows = [(0, 0, 1.0, True, 0.1), (0, 1, 0.6, True, -0.1), (0, 2, 1.0, True, 0.0), (5, 5, 0.4, True, 1.0), (5, 6, 9.0, False, 1.0), (6, 6, None, True, 1.0), (7, 7, 9.0, None, 1.0)]
    px = spark.createDataFrame(rows, "r int, c int, distance double, forest boolean, greenness_loss double")
    got = {(x.r, x.c): (x.greener, x.px) for x in stack.build_stack(px, [0.5, 0.9]).collect()}
    assert got == {(0, 0): (0, [3, 1]), (0, 1): (1, [3, 0]), (0, 2): (1, [3, 1]), (5, 5): (0, [0, 0]), (6, 6): (0, [0, 0])}
    gated = {(x.r, x.c): x.px for x in stack.build_stack(px, [0.5, 0.9], gate_first=True).collect()}
    assert gated[0, 0] == [1, 1] and gated[0, 1] == [0, 0]
    assert stack.build_stack(px.limit(0), [0.5]).count() == 0
    with pytest.raises(ValueError):
        stack.build_stack(px, [0.5, 0.5])
