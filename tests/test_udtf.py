"""Sentences cut by a table function in SQL."""

import numpy as np
import pytest

from tidemark.operators import segmentation


def test_cut_sentences_gives_segments(spark):
    rng, rows = np.random.default_rng(8), []
    for v in range(6):
        at = 0.0
        for pos in range(400 if v else 3):
            text = "w" + rng.choice(["", "", "", "", "", ",", ";", ".", "?"], p=[0.15] * 5 + [0.1, 0.05, 0.08, 0.02])
            length = round(float(rng.choice([0.3, 0.6, 4.0], p=[0.6, 0.35, 0.05])), 2)
            rows.append((f"v{v}", pos, text, round(at, 2), round(at + length, 2)))
            at += length + float(rng.choice([0.0, 0.1, 1.5]))
    words = spark.createDataFrame(rows, "video_id string, pos int, text string, start double, end double").repartition(3)
    words.createOrReplaceTempView("words_to_cut")
    segmentation.register_udtfs(spark)
    got = spark.sql("SELECT * FROM cut_sentences(TABLE(words_to_cut) PARTITION BY video_id ORDER BY pos)")
    want = segmentation.segments(words)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(Exception, match="lacks"):
        spark.sql("SELECT * FROM cut_sentences(TABLE(SELECT 1 AS pos))").collect()
    assert spark.sql("SELECT * FROM cut_sentences(TABLE(SELECT * FROM words_to_cut WHERE pos < 0) PARTITION BY video_id ORDER BY pos)").count() == 0
