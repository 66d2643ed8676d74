import numpy as np

from quakespark.operators import weights
from quakespark.params import IterationParams


def test_spreads_without_keys_shuffle_no_link(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 4) + 1, 1.0, float(r), 100.0) for i, r in enumerate(rng.normal(0, 0.1, 401))]
    links = spark.createDataFrame([*rows, (None, 1.0, 0.1, 100.0), (3, 1.0, None, 100.0)], "idx int, qual double, res double, offs_m double")
    step = IterationParams(last=1, w_ccp=1.0, w_ccs=1.0, w_ctp=1.0, w_cts=1.0, res_cc=6.0, res_ct=3.0)
    out = weights.weights(links, step)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    want = []
    for cc, limit in ((True, 6.0), (False, 3.0)):
        res = np.array([r[2] for r in rows if (r[0] <= 2) == cc])
        mad = np.median(np.abs(res - np.median(res))) / weights.MAD_SCALE
        want += (1 - (np.abs(res) / (limit * mad)) ** 3) ** 3,
    got = out.filter("res is not null").collect()
    for cc, expected in zip((True, False), want, strict=True):
        np.testing.assert_allclose(sorted(r.wt for r in got if (r.idx <= 2) == cc), np.sort(expected), rtol=1e-9)
    assert len(got) == 401 and out.count() == 402
