"""Places of several sizes compared at once."""

import numpy as np
import pyarrow as pa

from cargolens.graph import vector_knn as V


def test_good_pairs_are_kept_beside_better_ones_that_are_known_already(monkeypatch):
    monkeypatch.setattr(V, "CELLS", 200)
    rng = np.random.default_rng(2)
    place = np.repeat([7, 8, 9, 10], [5, 12, 1, 12])
    ids, fresh = np.concatenate([np.arange(5), np.arange(12), [3], np.r_[np.arange(11), 0]]), rng.random(30) < 0.4
    v = rng.normal(size=(30, 3)).round(2)
    rows = pa.table({"place": place, "id": ids, "v": pa.array(v.tolist()), "floor": np.full(30, 0.4), "fresh": fresh})
    want = set()
    for p in set(place.tolist()):
        own = {}
        for i in sorted(np.flatnonzero(place == p), key=lambda i: not fresh[i]):
            own.setdefault(ids[i], i)
        for a, i in own.items():
            alike = {b: round((1 + v[i] @ v[j] / np.linalg.norm(v[i]) / np.linalg.norm(v[j])) / 2, 9) for b, j in own.items() if a != b and (fresh[i] or fresh[j])}
            good = sorted((x for x in alike.values() if x >= 0.4), reverse=True)
            # the third best is the bound for k = 2; before, one that was not good could be the bound
            want |= {(p, a, b) for b, x in alike.items() if x >= 0.4 and x >= (good[2] if len(good) > 2 else -1)}
    got = V._compared(rows, "COSINE", 2)
    assert got.num_rows == len(want) and {(a, b) for a, b in zip(got.column("src").to_pylist(), got.column("dst").to_pylist(), strict=True)} == {(a, b) for _, a, b in want}
