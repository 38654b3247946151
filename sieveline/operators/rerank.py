"""Re-ranking of candidates by a classifier trained on the review."""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sieveline.functions.vectors import dot
from sieveline.settings import RERANK_KEEP
from sieveline.staging import stage


def class_sizes(training, label="label_included"):
    sizes = training.agg(
        F.count_if(F.col(label) == 1).alias("positive"), F.count_if(F.col(label) == 0).alias("negative")
    ).first()
    return sizes.positive, sizes.negative


def balance(training, sizes, label="label_included"):
    """Add `weight` so that both classes have the same total weight."""
    positive, negative = sizes
    total = positive + negative
    weight = F.when(F.col(label) == 1, total / (2.0 * positive)).otherwise(total / (2.0 * negative))
    return training.withColumn("weight", weight)


def fit_classifier(training, label="label_included", vector_col="embedding", c=1.0, max_iter=100, tol=1e-6):
    """Logistic model with an L2 penalty of strength 1/c on the summed loss.

    Spark averages the loss over the weights, so the penalty is divided by
    their sum, which `balance` makes the number of rows.
    """
    training = stage(training.select(label, vector_col), "training")
    sizes = class_sizes(training, label)
    if 0 in sizes:
        raise ValueError(f"both classes are needed, got {sizes[0]} included and {sizes[1]} excluded")
    rows = balance(training, sizes, label).select(
        F.col(label).cast("double").alias("label"), "weight", array_to_vector(vector_col).alias("features")
    )
    penalty = 1.0 / (c * sum(sizes))
    return LogisticRegression(
        weightCol="weight", regParam=penalty, standardization=False, maxIter=max_iter, tol=tol
    ).fit(rows)


def logistic(training, vector_col="embedding", output="relevance_score"):
    """The scoring function of the balanced logistic model of `training`."""
    model = fit_classifier(training, vector_col=vector_col)
    return lambda candidates: score(model, candidates, vector_col, output)


def mean_difference(training, label="label_included", vector_col="embedding"):
    """Mean vector of the included rows less that of the others."""
    numbers = training.select(label, F.posexplode(vector_col).alias("place", "x"))
    x = F.col("x").cast("double")
    means = numbers.groupBy("place").agg(
        F.avg(F.when(F.col(label) == 1, x)).alias("one"), F.avg(F.when(F.col(label) == 0, x)).alias("none")
    )
    return [row.one - row.none for row in means.orderBy("place").collect()]


def linear(training, vector_col="embedding", output="relevance_score"):
    """A scoring function without a fit: the product with the difference of the class means."""
    direction = F.array(*map(F.lit, mean_difference(training, vector_col=vector_col)))
    return lambda candidates: candidates.withColumn(output, dot(F.col(vector_col), direction))


def largest_gradient(model, training, label="label_included", vector_col="embedding", c=1.0):
    """Largest absolute partial derivative of the penalised mean loss at the fit.

    It is zero at the optimum. The intercept is not penalised.
    """
    sizes = class_sizes(training, label)
    penalty = 1.0 / (c * sum(sizes))
    rows = score(model, balance(training, sizes, label), vector_col, "_p").select(
        (F.col("weight") * (F.col("_p") - F.col(label)) / sum(sizes)).alias("pull"), vector_col
    )
    slopes = rows.select("pull", F.posexplode(vector_col).alias("place", "x")).groupBy("place")
    slopes = {row.place: row.s for row in slopes.agg(F.sum(F.col("pull") * F.col("x").cast("double")).alias("s")).collect()}
    slope = rows.agg(F.sum("pull")).first()[0]
    return max(abs(slope), *(abs(slopes[n] + penalty * x) for n, x in enumerate(model.coefficients)))


def score(model, candidates, vector_col="embedding", output="relevance_score"):
    featured = candidates.withColumn("features", array_to_vector(vector_col))
    scored = model.transform(featured)
    return scored.withColumn(output, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def top_scored(scored, keep=RERANK_KEEP, output="relevance_score"):
    return scored.orderBy(F.col(output).desc_nulls_last(), "id").limit(keep)
