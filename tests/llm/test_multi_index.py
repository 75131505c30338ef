import numpy as np

from paylens.llm import multi_index as mi


def brute(rows, similarity=0.98):
    usable = {}
    for i, e, label, *_ in rows:
        if i is not None and label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            usable[i] = (label, np.array(e, float))
    links = {i: [j for j in usable if j != i and usable[i][0] == usable[j][0]
                 and len(usable[i][1]) == len(usable[j][1]) and usable[i][1] @ usable[j][1] / (np.linalg.norm(usable[i][1]) * np.linalg.norm(usable[j][1]))
                 >= similarity] for i in usable}
    out = {}
    for i, *_ in rows:
        group, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in group:
                    group.add(j)
                    todo.append(j)
        low = None if i is None else min(group)
        out[i] = (len(links.get(i, ())), low, i is None or low == i)
    return out


def vectors(rng, n, dim, spread):
    centres = rng.normal(size=(12, dim))
    return [(int(i), (centres[i % 12] + spread * rng.normal(size=dim) * rng.random()).astype(np.float32).tolist(),
             int(i) % 12 % 3, "x") for i in range(n)]


SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string"


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mi, "BLOCK", 64)  # several blocks per cell
    rng = np.random.default_rng(8)
    rows = vectors(rng, 500, 16, 0.35)
    rows += [(1000 + i, rows[7][1], rows[7][2], "x") for i in range(70)]  # copies
    rows += [(1100, [2 * x for x in rows[7][1]], rows[7][2], "x"), (1101, rows[7][1], None, "x"), (1102, None, 1, "x"),
             (1103, [0.0] * 16, 1, "x"), (1104, [float("nan")] + [1.0] * 15, 1, "x"), (1105, [None] + [1.0] * 15, 1, "x"),
             (1106, [float("inf")] + [1.0] * 15, 1, "x"), (1107, [1.0] * 4, 1, "x"), (1108, [1.0] * 4, 1, "x"),
             (1110, [1.0] * 3, 1, "x"), (1111, [1.0] * 3, 1, "x"), (1112, [2.0] * 3, 1, "x"), (1113, [1.0] * 3, 2, "x"),
             (1109, [], 1, "x"), (None, rows[7][1], rows[7][2], "x"), (1000, rows[7][1], rows[7][2], "x")]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in mi.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)
    assert max(v[0] for v in got.values()) > 70 and sum(v[0] > 0 for v in got.values()) > 200


def test_empty_and_unusable_tables(spark):
    frame = spark.createDataFrame([(1, None, 1, "x"), (2, [0.0], 1, "x")], SCHEMA)
    assert mi.near_duplicates(frame.limit(0)).count() == 0
    assert {tuple(r) for r in mi.near_duplicates(frame).collect()} == {(1, 0, 1, True), (2, 0, 2, True)}
    one = spark.createDataFrame([(1, [3.0], 1, "x"), (2, [5.0], 1, "x"), (3, [-5.0], 1, "x")], SCHEMA)
    assert {tuple(r) for r in mi.near_duplicates(one).collect()} == {(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)}


def test_lengths_link_among_themselves(spark):
    rows = [(1, [1.0, 2.0], 1, "x"), (2, [1.0, 2.0], 1, "x"), *[(i, [1.0, 2.0, 3.0], 1, "x") for i in (3, 4, 5)]]
    got = {r.vec_id: (r.n_links, r.component_id) for r in mi.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 3), 4: (2, 3), 5: (2, 3)}


def test_doubles_keep_their_precision(spark):
    rows = [(1, [1.0, 1e-12], 1, "x"), (2, [1.0, 0.0], 1, "x"), (3, [1e300, 1e300], 1, "x"), (4, [1e-300, 1e-300], 1, "x")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, part string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in mi.near_duplicates(frame).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3)}


def test_cells_are_visited_in_order_of_distance():
    rng = np.random.default_rng(9)
    x = mi.unit([np.array(e).tobytes() for _, e, _, _ in vectors(rng, 900, 32, 0.2)], 32)
    index = mi.fit(x, 400 * 64, 0.98, 0.99)
    low = [mi._squares(x[:, h], b) for h, b in zip((slice(0, 16), slice(16, 32)), index.books)]
    sums = (low[0][:, :, None] + low[1][:, None, :]).reshape(len(x), -1)
    assert 1 <= index.visits < index.cells and index.cells >= 49
    for row, found in zip(sums, index.locate(x, 20)):
        assert len(set(found.tolist())) == 20
        assert np.allclose(row[found], np.sort(row)[:20])
    # A link at the threshold or above is met from either side at least this often.
    near = index.locate(x)
    linked = np.argwhere(np.triu(x @ x.T >= 0.98, 1))
    met = [near[b, 0] in near[a] or near[a, 0] in near[b] for a, b in linked]
    assert len(linked) > 500 and np.mean(met) >= 0.99
    assert mi.fit(x, 400 * 64, 0.98, 0.5).visits <= index.visits
    assert mi.fit(x, 400 * 64, 0.98, 1.0).visits == index.cells


def test_recall_over_many_cells(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(1800, 24))
    data = np.vstack([base, base[:900] + 0.09 * rng.normal(size=(900, 24)), base[:300] + 0.12 * rng.normal(size=(300, 24))])
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>, label int")
    x = data / np.linalg.norm(data, axis=1, keepdims=True)
    true = (x @ x.T >= 0.98).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in mi.near_duplicates(frame).collect()}
    assert all(got[i] <= n for i, n in enumerate(true)) and true.sum() > 1000
    assert sum(got.values()) >= 0.99 * true.sum()
    exact = {r.vec_id: r.n_links for r in mi.near_duplicates(frame, target_recall=1.0).collect()}
    assert [exact[i] for i in range(len(data))] == true.tolist()
