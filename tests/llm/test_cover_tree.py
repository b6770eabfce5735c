import math

import numpy as np
import pytest

from delaystar.llm import cover_tree


def frame(spark, rows, more=""):
    schema = "vec_id bigint, embedding array<float>, label int" + "".join(f", {c} bigint" for c in more.split())
    return spark.createDataFrame([(i, v, 0, *(5 for _ in more.split())) for i, v in rows], schema)


def brute(rows, similarity=0.9):
    """(vec_id, links, component, kept) of each row by comparing all pairs in double precision."""
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [k for k, (_, v) in enumerate(rows) if usable(v)]
    width = max((len(rows[k][1]) for k in good), default=1)
    x = np.zeros((len(good), width))
    for r, k in zip(x, good, strict=True):
        r[: len(rows[k][1])] = np.float32(rows[k][1])
    norm = np.sqrt((x * x).sum(axis=1))
    near = (x @ x.T) / np.outer(norm, norm) >= similarity
    np.fill_diagonal(near, False)
    label = {k: k for k in range(len(rows))}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, j in zip(*np.nonzero(near), strict=True):
        label[find(good[i])] = find(good[j])
    links = dict(zip(good, near.sum(axis=1).tolist(), strict=True))
    least: dict = {}
    for k, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[find(k)] = min(least.get(find(k), vec_id), vec_id)
    return sorted(((v, links.get(k, 0), least.get(find(k)), v == least.get(find(k))) for k, (v, _) in enumerate(rows)), key=repr)


def got(df, similarity=0.9):
    return sorted(map(tuple, cover_tree.near_vectors(df, similarity).collect()), key=repr)


def vectors(seed, n=300, dims=16, groups=6):
    """Random directions, groups of near copies of many tightnesses, chains, exact and scaled copies."""
    rnd = np.random.default_rng(seed)
    parts = [rnd.normal(size=(n, dims))]
    for _ in range(groups):
        centre = rnd.normal(size=dims)
        parts.append(centre + rnd.normal(size=(int(rnd.integers(5, 60)), dims)) * rnd.choice([0.001, 0.1, 0.25, 0.35]))
    turn = np.linspace(0, 3, 25)
    chain = np.zeros((25, dims))
    chain[:, 0], chain[:, 1] = np.cos(turn), np.sin(turn)
    copies = np.repeat(parts[1][:3], 9, axis=0)
    parts += [chain, copies, parts[0][:5] * 4, -parts[0][:5]]
    flat = np.concatenate(parts).astype(np.float32)
    ids = rnd.permutation(len(flat))
    return [(int(i), v.tolist()) for i, v in zip(ids, flat, strict=True)]


@pytest.mark.parametrize("seed, dims, similarity", [(1, 16, 0.9), (2, 3, 0.9), (3, 64, 0.9), (4, 8, 0.6)])
def test_links_and_components_equal_all_pairs(spark, monkeypatch, seed, dims, similarity):
    monkeypatch.setattr(cover_tree, "CELL", 60)  # many cells, pivots split over several
    monkeypatch.setattr(cover_tree, "SAMPLE", 80)
    rows = vectors(seed, dims=dims)
    assert got(frame(spark, rows), similarity) == brute(rows, similarity)


def test_one_cell_and_the_given_table(spark):
    rows = vectors(7)
    assert got(frame(spark, rows)) == brute(rows)
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert got(table) == brute([(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_hot_group_of_near_copies_over_many_cells(spark, monkeypatch):
    """A third of all vectors around one direction, some within the threshold of each other, some not."""
    monkeypatch.setattr(cover_tree, "CELL", 50)
    rnd = np.random.default_rng(5)
    hot = np.concatenate([np.r_[1.0, np.zeros(11)] + rnd.normal(size=(200, 12)) * 0.02, np.r_[1.0, np.zeros(11)] + rnd.normal(size=(100, 12)) * 0.15])
    flat = np.concatenate([hot, rnd.normal(size=(600, 12))]).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(flat)]
    assert got(frame(spark, rows)) == brute(rows)


def test_tree_nests_covers_and_halves():
    units = cover_tree.unit(np.array([v for _, v in vectors(9, dims=5)]) + 1e-3)
    order, levels = cover_tree.build_tree(units)
    units = units[order]
    assert sorted(order) == list(range(len(units)))
    for depth, (level, below) in enumerate(zip(levels, levels[1:], strict=False), 1):
        assert set(level["centre"]) <= set(below["centre"])
        for k in range(len(level["centre"])):
            lo, hi = level["lo"][k], level["hi"][k]
            angle = np.arccos(np.clip(units[lo:hi] @ units[level["centre"][k]], -1, 1))
            assert lo <= level["centre"][k] < hi
            assert angle.max() <= level["rho"][k] + 1e-7
            children = range(level["child"][k], level["child"][k + 1])
            assert [below["lo"][c] for c in children][0] == lo and [below["hi"][c] for c in children][-1] == hi
            centres = units[below["centre"][list(children)]]
            apart = np.arccos(np.clip(centres @ centres.T, -1, 1)) + np.eye(len(centres)) * 9
            if depth < cover_tree.LEVELS:
                assert apart.min() > math.pi / 2**depth - 1e-7 and below["rho"][list(children)].max() <= math.pi / 2**depth + 1e-7


def test_far_nodes_are_pruned_and_close_ones_linked_whole(monkeypatch):
    """Two tight bundles: members of different bundles are never compared, members of one bundle not one by one."""
    rnd = np.random.default_rng(2)
    base = np.eye(20)
    flat = np.concatenate([base[k] + rnd.normal(size=(60, 20)) * 0.002 for k in range(4)])
    raw = flat.astype(np.float32).astype(np.float64)
    order, levels = cover_tree.build_tree(cover_tree.unit(raw))
    cell = cover_tree.Cell(cover_tree.Cell.pack(raw[order], np.ones(len(raw), np.int64), levels))
    compared = []
    nonzero = np.nonzero
    monkeypatch.setattr(cover_tree.np, "nonzero", lambda x: (compared.append(x.size), nonzero(x))[1])
    counts, _, links = cover_tree.meet(cell, cell, 0.9, True)
    assert (counts == 59).all()
    assert sum(compared) < 1000 < len(raw) ** 2
    assert len(links) < 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
            (None, [2.0, 0.0]), (9, [3.0, 0.0, 0.0]), (8, [-1.0, 0.0]), (None, [0.0, 5.0]), (None, None), (10, [-0.0, 1e38]), (11, [1e-38, 1e-38])]
    assert got(frame(spark, rows, more="k1 cell n_links KEPT")) == brute([(i, v) for i, v in rows])
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(1, None), (None, [0.0])])) == [(1, 0, 1, True), (None, 0, None, True)]
