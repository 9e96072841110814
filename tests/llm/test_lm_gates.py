"""Every predictor's gate weights learn from every block."""

import numpy as np
import pyarrow as pa

from docloom.llm import lm_score


def test_one_block_moves_all_predictors():
    model, counts = lm_score.Model(), lm_score.Counts()
    s = lm_score.tokenise(pa.array(["the cat sat on the mat while another animal considered something unusual " * 5]))
    p, _, _ = lm_score.places(s)
    assert len(p.byte) < lm_score.ROWS
    for _ in range(2):
        model.bits(p, counts)
        counts.show(model)
    assert all((w != np.float32(0.3)).any() for w in model.weights)
