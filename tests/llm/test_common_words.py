"""The most frequent words are found by a histogram, not by a sort at the driver."""

from __future__ import annotations

import pytest

from parvis.llm import lm


@pytest.mark.parametrize("most", [0, 1, 10, 100, 5000])
def test_words_above_a_count(spark, most):
    counts = [(k, 1 + k * k * k % 70_001) for k in range(900)] + [(-k, 3) for k in range(1, 200)]
    df = spark.createDataFrame(counts, "key long, n long").repartition(5)
    got = {tuple(r) for r in lm._most_frequent(df, most).collect()}
    assert len(got) <= most and got <= set(counts)
    least = min((n for _, n in got), default=1 << 40)
    assert not [c for c in counts if c not in got and c[1] >= least]
    left = [n for k, n in counts if (k, n) not in got]
    if left:  # the next step of the histogram would not fit
        wide = max(max(left).bit_length() - 9, 0)
        step = [n for n in left if n >> wide == max(left) >> wide]
        assert len(got) + len(step) > most
    assert lm._most_frequent(df.where("false"), most).count() == 0
