"""Columns of the input may bear any name the mixture works with."""

from pyspark.sql import functions as F

from basketry.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = ["epoch", "domain", "n_tokens", "__n", "__times", "__epoch", "__row", "__domain", "__lang", "__source", "__cut", "__epochs"]


def test_mixture_keeps_clashing_columns(spark):
    rows = [(i, f"one two three {i}", ["en", "de", None][i % 3], ["src0", "src1", None][i % 3], 9) for i in range(60)]
    rows += [(None, "no id at all", "en", "src0", 3), (7, None, "en", "src0", 0), (8, "", "en", "src1", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plain = mixing.select_mixture(docs)
    clash = docs.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])
    got = mixing.select_mixture(clash)
    assert got.columns == clash.columns
    assert sorted(map(str, got.select(*docs.columns).collect())) == sorted(map(str, plain.collect()))
    assert got.select(*NAMES).distinct().collect() == [tuple(f"own {n}" for n in NAMES)]
    added = mixing.select_mixture(clash, with_epoch=True)
    assert added.columns.count("epoch") == 1 and added.schema["epoch"].dataType.simpleString() == "int"
    assert added.count() == got.count() > 0
    assert mixing.select_mixture(clash.limit(0)).count() == 0
