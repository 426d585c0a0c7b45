"""Links of near vectors against comparing all pairs, with groups of copies, near copies and crowded filters."""

import numpy as np
import pytest

from tidemark.llm import cap_filters, queries
from tidemark.sources.shared import new_folder

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.9):
    """n_links and component_id of each row, by comparing all pairs."""
    units = []
    for _, vector in rows:
        values = np.array([np.nan if x is None else x for x in vector or []], dtype=np.float32).astype(np.float64)
        usable = len(values) and np.isfinite(values).all() and values.any()
        units.append(values / np.linalg.norm(values) if usable else None)
    near = np.array([[a is not b and x is not None and y is not None and len(x) == len(y) and x @ y >= cosine
                      for b, y in enumerate(units)] for a, x in enumerate(units)])
    np.fill_diagonal(near, False)
    root = list(range(len(rows)))
    for _ in rows:
        moved = [min([root[i], *(root[j] for j in np.flatnonzero(near[i]))]) for i in range(len(rows))]
        if moved == root:
            break
        root = moved
    ids = [[rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None] for i in range(len(rows))]
    return sorted(
        ((row[0], int(near[i].sum()), min(ids[i], default=None)) for i, row in enumerate(rows)),
        key=lambda x: (x[0] is None, x),
    )


def vectors(random, groups, alone, length=64, spread=0.1):
    """Rows around some centres and rows on their own, ids shuffled."""
    found = []
    for size, wide in groups:
        centre = random.standard_normal(length)
        around = random.standard_normal((size, length)) * spread * wide + centre
        found += list(around)
    found += list(random.standard_normal((alone, length)))
    ids = random.permutation(len(found)).tolist()
    return [(i, v.astype(np.float32).tolist()) for i, v in zip(ids, found, strict=True)]


def found_by(spark, rows, **options):
    frame = spark.createDataFrame([(*row, 0) for row in rows], SCHEMA)
    result = cap_filters.near_vectors(frame, **options).collect()
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in result), key=lambda x: (x[0] is None, x))


def test_links_are_those_of_all_pairs(spark):
    rows = vectors(np.random.default_rng(1), [(30, 1), (20, 1), (5, 0), (2, 1)], 300)
    rows += [(1000, rows[0][1]), (1001, [2 * x for x in rows[0][1]])]
    assert found_by(spark, rows) == plain(rows)


@pytest.mark.parametrize("spread", [1.0, 2.6])
def test_crowded_filters_lose_and_repeat_nothing(spark, monkeypatch, spread):
    """Tight groups become balls, wide ones are open at their edges or cut into blocks."""
    monkeypatch.setattr(cap_filters, "MOST_COMPARED", 12)
    monkeypatch.setattr(cap_filters, "MEETINGS", 60.0)
    cap_filters.design.cache_clear()
    rows = vectors(np.random.default_rng(2), [(60, spread), (50, spread), (40, 0.5)], 80)
    try:
        assert found_by(spark, rows) == plain(rows)
    finally:
        cap_filters.design.cache_clear()


def test_recall_at_the_least_cosine():
    random = np.random.default_rng(3)
    plan = cap_filters.design(50_000, 64, 0.9)
    one, other = (random.standard_normal((1000, 64)) for _ in range(2))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    passed = [set(zip(*(x.tolist() for x in cap_filters.decode(v, plan)), strict=True)) for v in (one, 0.9 * one + 0.19**0.5 * other)]
    assert len({row for row, _ in passed[0] & passed[1]}) >= 980


def test_decoding_finds_every_filter_above_the_height():
    plan = cap_filters.design(2000, 20, 0.9)
    units = np.random.default_rng(4).standard_normal((50, 20))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    expected = set()
    for number in range(cap_filters.CODES):
        rotation, words = cap_filters._code(number, 20, plan.blocks, plan.words)
        products = np.einsum("nkd,kwd->nkw", (units @ rotation).reshape(50, plan.blocks, -1), words)
        sums = products[:, 0]
        for k in range(1, plan.blocks):
            sums = (sums[:, :, None] + products[:, k][:, None]).reshape(50, -1)
        rows, at = np.nonzero(sums >= plan.height)
        expected |= {(int(r), number * plan.words**plan.blocks + int(a)) for r, a in zip(rows, at, strict=True)}
    assert set(zip(*(x.tolist() for x in cap_filters.decode(units, plan)), strict=True)) == expected


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.1]), (2, [1.0, 2.0, 3.1]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]),
        (6, [float("nan"), 1.0, 1.0]), (7, [None, 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]),
        (None, [1.0, 2.0, 2.9]), (None, [-5.0, 1.0, 0.0]), (None, None), (10, [1e30, 2e30, 3e30]), (11, [7.0]), (12, [3.0]),
    ]
    assert found_by(spark, rows) == plain(rows)


def test_clashing_names_doubles_and_no_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.5], 5, "x"), (2, [1.0, 0.5], 6, "y")], "node long, _vector array<double>, n_links int, component_id string")
    found = cap_filters.near_vectors(frame, vec_id="node", vector="_vector").collect()
    assert sorted(map(tuple, found)) == [(1, 1, 1), (2, 1, 1)]
    assert cap_filters.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark, small):
    rows = vectors(np.random.default_rng(6), [(40, 1), (3, 1)], 200)
    folder = new_folder(spark, "vectors")
    spark.createDataFrame([(*row, 0) for row in rows], SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    found = queries.REGISTRY["op12_cap_filters"](spark, folder).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
