import numpy as np

from tidemark.llm import lm


def test_sums_of_parameters_stay_exact_at_the_target_size():
    params = np.array([-50.0, 20.0, lm.LARGEST, -lm.LARGEST, 0.0, -1e-6, 0.3, 1e9])
    # 64 units of 2**35 windows each: 2**41 in all
    total = sum(lm.weighted(params, 1 << 35) for _ in range(64))
    assert total[0] == 1 << 41
    want = np.rint(np.clip(params, -lm.LARGEST, lm.LARGEST) * lm.SCALE) / lm.SCALE
    assert (lm.averaged(total) == want).all()
    # units weigh by their windows
    mixed = lm.weighted(np.array([1.0, -50.0]), 3) + lm.weighted(np.array([5.0, -10.0]), 1)
    assert lm.averaged(mixed).tolist() == [2.0, -40.0]
