import numpy as np
import pytest
from tests.llm.test_simhash import plain_sets

from chainlake.llm.embedding_dedup import near_cells, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, key long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, g, 5) for i, v, g in rows], SCHEMA).repartition(3)


def plain(rows):
    def unit(v, g):
        if g is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        e = np.array(np.float32(v), np.float64)
        return e / np.linalg.norm(e)

    units = [unit(v, g) for _, v, g in rows]

    def linked(i, j):
        a, b = units[i], units[j]
        return (i != j and a is not None and b is not None and rows[i][2] == rows[j][2]
                and len(a) == len(b) and float(a @ b) >= 0.98)

    sets = plain_sets(list(range(len(rows))), linked)
    out = []
    for i, (vid, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if sets[j] == sets[i] and rows[j][0] is not None]
        least = min(ids) if ids else None
        kept = None if vid is None or least is None else vid == least
        out.append((vid, sum(linked(i, j) for j in range(len(rows))), least, kept))
    return sorted(out, key=repr)


def sample(seed, n=220, dim=8):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 25))):
            base = base + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1])
            rows.append((len(rows), [float(np.float32(x)) for x in base], int(rng.integers(0, 2))))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * dim, [nan] * dim, [1.0] * (dim - 1) + [inf], [None] + [1.0] * (dim - 1), [1.0] * 3, [1.0] * 3]
    rows += [(n + 50 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(n + 70, rows[0][1], None), (None, rows[0][1], rows[0][2]), rows[1], rows[1]]
    return rows


@pytest.mark.parametrize("per_pivot, block", [(10, 7), (40, 4000), (10_000, 4000)])
def test_against_all_pairs(spark, per_pivot, block):
    rows = sample(per_pivot)
    got = near_duplicates(table(spark, rows), rows_per_pivot=per_pivot, block_rows=block).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_empty(spark):
    assert near_duplicates(table(spark, [])).count() == 0


def test_no_link_crosses_an_unshared_boundary():
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(400, 4))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    own, mask = near_cells(unit, unit[:25], 0.2)
    close = np.linalg.norm(unit[:, None] - unit[None], axis=2) <= 0.2
    for i, j in zip(*np.nonzero(close)):
        assert mask[j, own[i]]
    assert mask.mean() < 0.6
