"""Null and repeated ids, and samples of a bounded size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklake.llm import near_join, quality_model
from sparklake.llm.common import save


def _near_pairs(n):
    out = []
    for i in range(n):
        words = [f"w{i}x{j}" for j in range(60)]
        out += [" ".join(words), " ".join([*words[:-1], "edited"])]
    return out


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i if i % 2 else None])
def test_near_join_reads_one_row_for_each_wanted_class(spark, ids):
    texts = _near_pairs(30)
    rows = [(ids(i), t) for i, t in enumerate(texts)] * 3  # all three times
    docs = save(spark.createDataFrame(rows, "doc_id long, text string"), "t_hot")
    keyed = docs.select("doc_id", "text", *near_join.content_key(docs, ["doc_id", "text"]))
    counted = save(keyed.mapInArrow(near_join._counted_tokens, "doc_id long, key_a long, key_b long, class string, key long, n long, "
                                                               "tokens array<long>, tested int"), "t_rows")
    wanted = save(near_join.candidates(counted), "t_wanted")
    assert wanted.count() == 60 and wanted.where("repeated").count() == 60
    assert near_join.wanted_texts(docs, wanted).count() == 60
    found = near_join.with_components(docs)
    assert found.count() == len(rows) and found.where("component IS NULL").count() == 0
    assert found.groupBy("component").count().collect() and {r["count"] for r in found.groupBy("component").count().collect()} == {6}


@pytest.mark.parametrize("parts", [1, 40])
def test_training_sample_is_small_before_it_is_ordered(spark, parts):
    width = len(quality_model.FEATURES)
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.array(*[F.rand(i) for i in range(width)]).alias("x"))
    rows = save(rows.unionAll(rows.where("doc_id < 50")).repartition(parts), "t_x")
    labels = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    sample = quality_model.training_sample(rows, labels, 100)
    assert sample.count() == 100
    x, y = quality_model.training_rows(rows, labels, 100)
    again, _ = quality_model.training_rows(rows.repartition(3), labels, 100)
    assert x.shape == (100, width) and np.array_equal(x, again) and set(y) == {0.0, 1.0}
    every, _ = quality_model.training_rows(rows, labels, 10**6)
    assert len(every) == rows.select("doc_id").distinct().where(~quality_model.held_out()).count()


def test_training_sample_of_nothing(spark):
    rows = spark.createDataFrame([], "doc_id long, x array<double>")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    x, y = quality_model.training_rows(rows, labels)
    assert x.shape == (0, len(quality_model.FEATURES)) and not len(y)
