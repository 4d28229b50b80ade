"""The logistic curve over margins, wherever these lie."""

import numpy as np
import pytest

from fleetpulse.llm.training import fit_probability, sigmoid


@pytest.mark.parametrize("low, high, spread", [(-8, 8, 1), (-30, 30, 5), (-3, 1, .2), (5, 9, .3), (-1, 9, .5)])
def test_separable_margins_get_decided_probabilities(low, high, spread):
    rng = np.random.default_rng(1)
    margins = np.concatenate([rng.normal(low, spread, 1500), rng.normal(high, spread, 1500)])
    a, b = fit_probability(margins, np.repeat([0, 1], 1500), {0: 61_250, 1: 6_976})
    p = sigmoid(a * margins + b)
    assert p[:1500].max() < 0.3 and p[1500:].min() > 0.7
