"""The n-gram join's candidate walk in proportion to its input, and rounds of the components that change nothing."""

import numpy as np
import pytest

from surveyframe.llm import components, setjoin


def test_sets_that_share_a_line_are_apart_where_buckets_are_first_compared():
    rng = np.random.default_rng(5)
    line = rng.integers(0, 2 ** 63, 10, dtype=np.uint64)
    sk = np.stack([setjoin.sketch(np.concatenate((line, rng.integers(0, 2 ** 63, 90, dtype=np.uint64)))) for _ in range(600)])
    root, pos = setjoin.roots()

    def meeting(depth):
        row, path = setjoin.first_paths(sk, root, pos, setjoin.THRESHOLD, depth)
        assert (np.diff(row) >= 0).all()
        _, which, n = np.unique(path, return_inverse=True, return_counts=True)
        return (n[which] > 1).sum() / len(sk)

    assert meeting(1) > 1  # rows a set in buckets of two or more, had the walk begun at the first level
    assert meeting(setjoin.FIRST) < 0.6


def test_recall_where_buckets_are_first_compared():
    rng = np.random.default_rng(12)
    pairs, size = 6000, setjoin.SKETCH
    a = rng.integers(0, 2 ** 32, (pairs, size), dtype=np.uint64).astype("<u4")
    b = np.where(rng.random((pairs, size)) < setjoin.THRESHOLD, a, rng.integers(0, 2 ** 32, (pairs, size), dtype=np.uint64).astype("<u4"))
    root, pos = setjoin.roots()
    assert setjoin.miss(pos, setjoin.FIRST) <= setjoin.FIRST_MISS and setjoin.miss(pos) <= 1 - setjoin.RECALL
    one, two = (setjoin.first_paths(x, root, pos, setjoin.THRESHOLD, setjoin.FIRST) for x in (a, b))
    both = {*zip(*map(np.ndarray.tolist, one))} & {*zip(*map(np.ndarray.tolist, two))}
    assert len({row for row, _ in both}) == pairs


@pytest.mark.parametrize("edges", [[], [(2, 1), (3, 1), (3, 1), (1, 1), (7, 5), (None, 4)]])
def test_stars_take_no_round(spark, monkeypatch, edges):
    monkeypatch.setattr(components, "_large_star", None)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {(2, 1), (3, 1), (1, 1), (7, 5), (5, 5)} if edges else set()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_components_of_paths_rings_and_hubs(spark):
    rnd = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, 203), (203, 201), (201, 202), (202, 200)] + [(399, i) for i in range(300, 399)]
    edges += [(int(a), int(b)) for a, b in rnd.integers(500, 600, (60, 2))]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {(x, y) for x, y in root.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_groups_of_one_block_need_no_components(spark, monkeypatch):
    base = [f"w{i}" for i in range(80)]
    rows = [(d, " ".join(base[:d % 3] + ["x"] + base[d % 3:])) for d in range(9)] + [(20, "quite another text of seven words"), (21, None)]
    seen = []

    def noted(edges, *names):
        out = components.connected_components(edges, *names)
        seen.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "connected_components", noted)
    got = {r.doc_id: (r.class_id, r.n_links) for r in setjoin.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: (0, 8) for d in range(9)} | {20: (20, 0), 21: (21, 0)}
    assert seen[1] == 0
