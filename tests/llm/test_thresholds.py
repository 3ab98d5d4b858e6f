"""Near duplicates at thresholds other than that of the query."""

import random

import pytest

from presscheck.llm import near_duplicates


def test_bands_follow_the_threshold():
    assert all(near_duplicates.banding(p) == (near_duplicates.BANDS, near_duplicates.ROWS) for p in (80, 90, 100))
    for percent in range(1, 101):
        bands, rows = near_duplicates.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= near_duplicates.MISS
    for percent in (0, -5, 101):
        with pytest.raises(ValueError):
            near_duplicates.banding(percent)


def test_pairs_at_half_are_found(spark):
    rng = random.Random(8)
    docs = []
    for i in range(60):
        words = [f"p{i}w{j}" for j in range(120)]
        # 60 of 120 different words in common with the whole.
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(rng.sample(words, 60)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates.find(frame, width=1, percent=50).collect()}
    assert found == {d: d // 2 * 2 for d, _ in docs}
