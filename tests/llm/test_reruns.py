"""Tasks that run again give what they gave before."""

import numpy as np

from ledgerloom.llm import quality


def test_rerun_sends_partial_sums_to_the_same_reducers(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(*map(float, rng.normal(size=len(quality.STATISTICS))), float(i % 2)) for i in range(64)], ", ".join(f"{s} double" for s in [*quality.STATISTICS, "y"])).repartition(8)
    held = spark.sparkContext.broadcast((np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS))))
    parts = quality.partial_equations(rows, held)
    first, again = (sorted((r.i, r.part, r.v[-1]) for r in parts.collect()) for _ in range(2))
    assert first == again and {p for _, p, _ in first} == set(range(8))
