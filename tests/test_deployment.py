"""The made-up deployment: one row a pair and epoch, the same rows whatever the partitions and blocks."""

from pyspark.sql import functions as F

from tickloom.operators import blocks, history
from tickloom.sources import deployment


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_are_a_function_of_seed_pair_and_epoch(spark, monkeypatch):
    made = rows(deployment.readings(spark, 2, 3, 50, seed=4, walk_ps=9.0))
    assert len(made) == 2 * 5 * 50 == len({r[:4] for r in made}) and all(0 <= r[5] < 200_000 for r in made)
    assert {(r[1], r[2]) for r in made} == {(f"mc{i}", c) for i in range(2) for c in ("mc0", "mc1", "hm0", "hm1", "hm2")}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    monkeypatch.setattr(blocks, "BLOCK_EPOCHS", 8)
    monkeypatch.setattr(blocks.block_of, "__defaults__", (8,))
    assert rows(deployment.readings(spark, 2, 3, 50, seed=4, walk_ps=9.0)) == made
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows(deployment.readings(spark, 2, 3, 50, seed=5, walk_ps=9.0)) != made
    shorter = rows(deployment.readings(spark, 2, 3, 20, seed=4, walk_ps=9.0))
    assert shorter == [r for r in made if r[3] < deployment.START_EPOCH + 20]
    assert deployment.readings(spark, 2, 3, 50, every_reference=False).select("ref", "clock").distinct().count() == 4 + 3


def test_its_clocks_are_tracked(spark):
    value = F.struct(F.lit(2).alias("states"), F.lit(20.0).alias("m"), F.lit(30.0).alias("m_sigma"), F.lit(50.0).alias("sigma0"), F.lit(40).alias("gap_limit"), F.lit(12).alias("breaks_at"), F.lit(144.0).alias("fraction_epochs"), F.lit(0.5).alias("fraction_limit"), F.lit(50).alias("rms_limit"))
    data = deployment.readings(spark, 2, 2, 40)
    found = history.pair_history(data, history.Setup(data.select("clock").distinct().withColumn("settings", value)))
    last = found.where(F.col("epoch") == deployment.START_EPOCH + 39).collect()
    assert len(last) == 8 and all("A" in r.flags for r in last)
