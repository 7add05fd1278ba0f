"""The conditioning of a unit goes up the whole ladder of its rivers' heights, wherever in a tall grid they lie."""

import numpy as np

from rillstone.queries import hydro


def test_humps_of_far_rows_are_lowered(spark, tmp_path):
    first = 11_200
    z = np.random.default_rng(5).normal(scale=0.1, size=(500, 64))
    spark.createDataFrame([(first + r, v.tolist()) for r, v in enumerate(z)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = hydro.i15(spark, str(tmp_path)).select("r", "c", "class").collect()
    assert len(out) == 500 * 64
    lowered = {r for r, _, code in out if code in (6, 7)}
    # most of eight humps of 23 rows
    assert len(lowered) > 100
