"""Every labelled training row enters op6's counts and curve."""

import random

import numpy as np

from basketry.llm import toxicity
from basketry.llm.words import batch_words
import pyarrow as pa
from pyspark.sql import functions as F


def test_all_training_rows_are_counted(spark):
    """Fold 4 (a quarter of the rows) entered no count before."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["bad", "good", "red", "blue", "tree"], [3 if i % 3 else 1, 1 if i % 3 else 3, 2, 2, 2], k=12)), int(i % 3 > 0)) for i in range(600)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("fold", toxicity.fold(F.col("doc_id")))
    only4 = data.withColumn("text", F.when(F.col("fold") == 4, F.concat("text", F.lit(" lateword"))).otherwise(F.col("text"))).cache()
    model = toxicity.train(only4.select("doc_id", "text"), only4.select("doc_id", "toxic"))
    late = batch_words(pa.array(["lateword"]), lower=True, plain=True).hash[0]
    assert late in model.words
    used = [r for r in only4.collect() if r.fold > 0]
    early = only4.filter("fold > 0").withColumn("early", F.col("fold") < 4)
    counted = toxicity._counted(early, 1, lambda h, doc: ([h], doc), 10 ** 6).toArrow()
    k = counted["k0"].to_numpy().view(np.uint64).tolist().index(int(late))
    got = [counted[c][k].as_py() for c in toxicity.COUNTS]
    assert got == [sum(r.fold == 4 and r.toxic == t for r in used) for t in (0, 1)] + [0, 0]


def test_curve_is_that_of_all_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (3000, 2))
    y = (rng.random(3000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))).astype(int)
    rows = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y, strict=True)], "x0 double, x1 double, y int").repartition(7)
    beta = toxicity.fit_curve(rows, ["x0", "x1"])
    p = 1 / (1 + np.exp(-(beta[0] + x @ beta[1:])))
    z = np.column_stack((np.ones(3000), x))
    assert np.abs(z.T @ (y - p)).max() < 0.1  # the likelihood's top, up to the ridge
    assert toxicity.fit_curve(rows.filter("y = 1"), ["x0", "x1"]).tolist() == [0.0, 0.0, 0.0]
