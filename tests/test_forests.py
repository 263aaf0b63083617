import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from sensorspark.operators import forests, models


def test_forests_score_batches_as_spark_does(spark):
    """To the last bit, at thresholds too, and with values appended for joint forests; no model runs row by row."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(500, 6)), 1)
    y = x[:, 0] * x[:, 1] + x[:, 5]
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y, strict=True)], "x array<double>, y double")
    rows = rows.select(array_to_vector("x").alias(models.FEATURES), array_to_vector(F.slice("x", 1, 4)).alias("short"), "y").repartition(3)
    deep = RandomForestRegressor(featuresCol=models.FEATURES, labelCol="y", numTrees=9, maxDepth=12, seed=1).fit(rows)
    stump = RandomForestRegressor(featuresCol=models.FEATURES, labelCol="y", numTrees=2, maxDepth=0, seed=1).fit(rows)
    theirs = deep.copy({deep.predictionCol: "theirs"}).transform(rows)
    found = theirs.withColumn("own", forests.predictions(theirs, models.FEATURES, [(deep, ()), (stump, ())]))
    got = found.select("theirs", F.get("own", F.lit(0)), F.get("own", F.lit(1))).collect()
    assert len(got) == 500 and all(a == b and abs(c - y.mean()) < 1 for a, b, c in got)
    told = array_to_vector(F.concat(vector_to_array("short"), F.array(F.lit(0.5), F.lit(-0.3))))
    appended = deep.copy({deep.predictionCol: "more", deep.featuresCol: "told"}).transform(rows.withColumn("told", told))
    both = appended.withColumn("own", forests.predictions(appended, "short", [(deep, [0.5, -0.3])])[0])
    assert both.where("more <> own or own is null").count() == 0 and both.count() == 500
    empty = rows.limit(0)
    assert empty.withColumn("own", forests.predictions(empty, models.FEATURES, [(deep, ())])).collect() == []
