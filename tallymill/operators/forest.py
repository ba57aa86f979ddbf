"""Demand forecast with a random forest."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallymill.functions.calendar import iso_weekday
from tallymill.functions.numbers import rmse
from tallymill.session import shared_folder, written_table

FEATURES = ["zone", "hour", "weekday", "month"]

# Size of the forest and the limit up to which a feature is categorical.
TREES = 101
DEPTH = 11
MAX_CATEGORIES = 24
#: Parts of the training rows; sampling goes by part, so it belongs to the model like the seed.
PARTS = 16


def _featured(df: DataFrame) -> DataFrame:
    return df.withColumns({"weekday": iso_weekday(F.col("day")), "month": F.month("day")})


def fit_forest(
    train: DataFrame,
    trees: int = TREES,
    depth: int = DEPTH,
    max_categories: int = MAX_CATEGORIES,
    seed: int = 1,
    parts: int = PARTS,
) -> PipelineModel:
    """Fit on (zone, day, hour, hires) rows. Categories unseen in training are kept as one more.

    Fitting passes over the rows several times, so they are written once in advance and laid out once
    in ``parts`` ordered parts, whatever the session's settings are: what they were derived from is not
    computed again for every pass, and the same rows and seed give the same trees.
    """
    rows = _featured(train).select(*FEATURES, F.col("hires").cast("double").alias("label"), "day")
    rows = written_table(rows, "forest-train")
    # Sampling goes by partition and row order; a fixed layout makes the seed repeatable.
    rows = rows.repartition(parts, "zone", "day", "hour").sortWithinPartitions("zone", "day", "hour")
    rows = rows.select(*FEATURES, "label").persist()
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        VectorIndexer(
            inputCol="features", outputCol="indexed", maxCategories=max_categories, handleInvalid="keep"
        ),
        RandomForestRegressor(featuresCol="indexed", numTrees=trees, maxDepth=depth, seed=seed),
    ]
    try:
        return Pipeline(stages=stages).fit(rows)
    finally:
        rows.unpersist()


def forest_forecast(model: PipelineModel, test: DataFrame) -> DataFrame:
    """(test_id, zone, day, hour, hires) with the prediction cut to an integer."""
    predicted = model.transform(_featured(test))
    hires = F.col("prediction").cast("int").alias("hires")
    return predicted.select("test_id", "zone", "day", "hour", hires).orderBy("test_id")


def forest_rmse(model: PipelineModel, labelled: DataFrame) -> DataFrame:
    """One row (rmse) over (zone, day, hour, hires) rows, from the uncut predictions."""
    predicted = model.transform(_featured(labelled))
    return predicted.agg(rmse(F.col("prediction"), F.col("hires")).alias("rmse"))


def forest_scores(model: PipelineModel, train: DataFrame, later: DataFrame) -> DataFrame:
    """(rows, n, rmse) of the training rows and of later rows that the fit has not seen."""
    columns = [*FEATURES, "hires"]
    both = _featured(train).select(F.lit("train").alias("rows"), *columns)
    both = both.unionByName(_featured(later).select(F.lit("later").alias("rows"), *columns))
    return model.transform(both).groupBy("rows").agg(F.count("*").alias("n"), rmse(F.col("prediction"), F.col("hires")).alias("rmse"))


def category_index(train: DataFrame, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """(feature, value, place, categories): the values of every categorical feature, numbered from 0 in order.

    A feature with more than ``max_categories`` distinct values in the training rows is a number and has no rows.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("value")) for i, c in enumerate(FEATURES)]))
    values = _featured(train).select(each.alias("x")).select("x.*").distinct()
    known = values.groupBy("feature").agg(F.count("*").alias("categories")).where(F.col("categories") <= max_categories)
    place = F.row_number().over(Window.partitionBy("feature").orderBy("value")) - 1
    return values.join(known, "feature").select("feature", "value", place.alias("place"), "categories")


def indexed_features(df: DataFrame, index: DataFrame) -> DataFrame:
    """The rows with ``features``, the array that the trees see: places of categories, and numbers as they are.

    A value that the training rows do not have gets the number of categories as its place. The index has
    at most ``max_categories`` rows a feature, so it is turned into one row and looked up.
    """
    entry = F.struct(F.concat_ws(":", "feature", "value"), F.col("place").cast("double"))
    counts = F.struct(F.col("feature").cast("string"), F.col("categories").cast("double"))
    packed = index.agg(F.map_from_entries(F.collect_set(entry)).alias("places"), F.map_from_entries(F.collect_set(counts)).alias("counts"))
    tables = packed.select(F.struct("places", "counts").alias("index")).scalar()

    def place(i: int, name: str) -> Column:
        value = F.col(name).cast("double")
        found = F.try_element_at(F.col("index.places"), F.concat_ws(":", F.lit(i), value))
        return F.coalesce(found, F.try_element_at(F.col("index.counts"), F.lit(str(i))), value)

    rows = _featured(df).withColumn("index", tables)
    return rows.withColumn("features", F.array(*[place(i, c) for i, c in enumerate(FEATURES)])).drop("index")


def forest_nodes(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(tree, node, prediction, feature, below, inside, beyond, left, right): the nodes of a fitted forest.

    A row goes left if its feature is at most ``below``, or one of ``inside`` for a categorical one; a category that the
    split does not know, ``beyond`` or higher, goes where more of the known ones go. Leaves have no feature. The number of nodes is bounded by the number and depth of the trees.
    """
    path = shared_folder(spark, "forest")
    model.stages[-1].save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    leaf, numeric = F.col("leftChild") < 0, F.col("split.numCategories") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    return nodes.select(
        "tree",
        F.col("id").alias("node"),
        "prediction",
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf & numeric, F.get(values, 0)).alias("below"),
        F.when(~leaf & ~numeric, values).alias("inside"),
        F.when(~leaf & ~numeric, F.col("split.numCategories")).alias("beyond"),
        F.when(~leaf, F.col("leftChild")).alias("left"),
        F.when(~leaf, F.col("rightChild")).alias("right"),
    )


def predict_by_joins(nodes: DataFrame, rows: DataFrame, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``rows`` (with ``features``) and ``prediction``, the mean over all trees of the leaf that each row falls into.

    Every row starts at the root of every tree and takes one join with the nodes for each level. The
    nodes are written, and their measured size decides on the joins.
    """
    nodes = written_table(nodes, "forest-nodes")
    kept = rows.columns
    at = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    at = at.withColumn("node", F.lit(0))
    for _ in range(depth):
        value = F.element_at("features", F.col("feature") + 1)
        unknown = (value >= F.col("beyond")) & (F.size("inside") > F.floor(F.col("beyond") / 2))
        goes_left = F.coalesce(value <= F.col("below"), F.array_contains("inside", value) | unknown)
        child = F.when(F.col("feature").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(nodes.select("tree", "node", "feature", "below", "inside", "beyond", "left", "right"), ["tree", "node"])
        at = at.withColumn("node", child).select(*kept, "row", "tree", "node")
    leaves = at.join(nodes.select("tree", "node", F.col("prediction").alias("leaf")), ["tree", "node"])
    return leaves.groupBy("row", *kept).agg(F.avg("leaf").alias("prediction")).drop("row")
