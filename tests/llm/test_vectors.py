import numpy as np
import pytest
from oracle_check import connect, differences

from tallyloom.llm.vectors import Quantiser, vector_links

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def brute(rows):
    """Links by cosine in double precision, components by the smallest id."""
    ok = {}
    for k, (_, v, label, _) in enumerate(rows):
        if label is not None and v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[k] = np.asarray(np.asarray(v, np.float32), float)
    ids = [-(2**63) if r[0] is None else r[0] for r in rows]
    keys = sorted(ok)
    unit = np.stack([ok[k] / np.linalg.norm(ok[k]) for k in keys])
    labels = np.array([rows[k][2] for k in keys])
    near = (unit @ unit.T >= 0.93 - 1e-12) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    links = dict.fromkeys(range(len(rows)), 0)
    comp = dict(enumerate(ids))
    for i, k in enumerate(keys):
        links[k] = int(near[i].sum())
    changed = True
    while changed:
        changed = False
        for i, k in enumerate(keys):
            low = min([comp[k]] + [comp[keys[j]] for j in np.flatnonzero(near[i])])
            if low < comp[k]:
                comp[k], changed = low, True
    back = lambda x: None if x == -(2**63) else x
    return sorted(((r[0], links[k], back(comp[k]), ids[k] == comp[k]) for k, r in enumerate(rows)), key=repr)


def clustered(rng, n, groups, noise, size=16):
    centres = rng.normal(size=(groups, size))
    x = centres[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, size))
    return x.astype(np.float32)


@pytest.mark.parametrize("seed,noise,block", [(0, 0.15, 4096), (1, 0.3, 40), (2, 0.05, 64)])
def test_against_brute_force(spark, seed, noise, block):
    rng = np.random.default_rng(seed)
    x = clustered(rng, 500, 60, noise)
    rows = [(i, [float(e) for e in v], int(rng.integers(0, 3)), "n") for i, v in enumerate(x)]
    rows += [(500 + i, rows[3][1], rows[3][2], "n") for i in range(40)]  # copies
    rows += [(600, rows[3][1], None, "n"), (601, None, 1, "n"), (602, [0.0] * 16, 1, "n"), (603, [1.0, None] * 8, 1, None), (604, [float("nan")] * 16, 1, "n"), (605, [float("inf")] + [1.0] * 15, 1, "n"), (606, [], 1, "n"), (607, [1.0] * 4, 1, "n"), (None, rows[7][1], rows[7][2], "n")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_links(df, list_rows=60, block=block, subspaces=4, reach=1.0).collect()), key=repr)
    assert got == brute(rows)


def test_recall_of_the_reach(spark):
    """Production reach on vectors whose links lie across list borders."""
    rng = np.random.default_rng(9)
    x = clustered(rng, 4000, 900, 0.17, 64)
    rows = [(i, [float(e) for e in v], 0, "n") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sum(r.n_links for r in vector_links(df, list_rows=60).collect())
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    want = int((unit @ unit.T >= 0.93).sum()) - len(x)
    assert want > 1000 and got == want


def test_links_along_a_line_are_found_from_both_ends(spark):
    """Production reach on vectors that differ straight across the list borders."""
    rng = np.random.default_rng(2)
    turn = np.sort(rng.uniform(0, np.pi, 1200))
    plane = np.linalg.qr(rng.normal(size=(16, 2)))[0]
    x = (np.stack([np.cos(turn), np.sin(turn)], 1) @ plane.T).astype(np.float32)
    rows = [(i, [float(e) for e in v], 0, "n") for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in vector_links(spark.createDataFrame(rows, SCHEMA), list_rows=60).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum(1) - 1
    assert [got[i] for i in range(len(x))] == want.tolist()


def test_vectors_of_several_lengths(spark):
    """Vectors link with those of their length only, also lengths that the sample has not."""
    rng = np.random.default_rng(5)
    rows = []
    for size, n in ((16, 300), (2, 200), (5, 3)):
        x = clustered(rng, n, max(1, n // 10), 0.1, size)
        rows += [(len(rows) + i, [float(e) for e in v], 0, "n") for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in vector_links(spark.createDataFrame(rows, SCHEMA), sample=100, list_rows=20).collect()}
    for k, (_, v, _, _) in enumerate(rows):
        same = np.array([w for _, w, _, _ in rows if len(w) == len(v)])
        unit = same / np.linalg.norm(same, axis=1)[:, None]
        assert got[k] == (unit @ (np.array(v) / np.linalg.norm(v)) >= 0.93).sum() - 1


def test_half_the_reach_probes_fewer_lists():
    rng = np.random.default_rng(6)
    x = clustered(rng, 3000, 300, 0.17, 64).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = Quantiser.fit(x, 50, 8, 1)
    far = np.sqrt(2 - 2 * 0.93)
    half, whole = (len(q.probes(x, q.gaps(), reach, far)[1]) for reach in (0.5, 1.0))
    assert half < whole / 2


def test_table_distances_are_those_of_the_codes():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24))
    q = Quantiser.fit(x, 5, 6, 1)
    rest = x - q.centres[0]
    codes, error = q.encode(rest)
    stands = np.concatenate([book[codes[:, m]] for m, book in enumerate(q.codes)], axis=1)
    assert np.allclose(error, np.linalg.norm(rest - stands, axis=1))
    exact = ((rest[:7, None, :] - stands[None]) ** 2).sum(2)
    assert np.allclose(q.distances(rest[:7], codes), exact, atol=1e-3)


def test_empty_table_and_no_usable_vector(spark):
    assert vector_links(spark.createDataFrame([], SCHEMA)).count() == 0
    one = vector_links(spark.createDataFrame([(1, None, None, None), (2, [0.0], 1, "")], SCHEMA)).collect()
    assert sorted(map(tuple, one)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, connect(sf), sf, "op4_vector_links") == []
