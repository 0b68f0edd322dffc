"""Results by key: upsert, pick, reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """new, and the rows of old whose key is not in new."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def pick(df: DataFrame, key: str, keys: list, strict: bool = True) -> DataFrame:
    """The rows of the keys in their order, as column place; a missing key raises an error if strict.

    The few keys are broadcast to find their rows; which of them have none is seen among those rows.
    """
    spark = df.sparkSession
    wanted = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"`{key}` {df.schema[key].dataType.simpleString()}, place int")
    found = df.join(F.broadcast(wanted.select(key)), key, "left_semi").withColumn("_has", F.lit(True))
    out = wanted.join(found, key, "left")
    if strict:
        out = out.withColumn("_has", F.when(F.col("_has").isNull(), F.raise_error(F.lit("a key has no result"))).otherwise(F.col("_has"))).filter("_has")
    return out.drop("_has")


def summary_json(fields: dict[str, Column], metrics: dict[str, Column]) -> Column:
    """One nested JSON object: the fields, and the metrics below `metrics`."""
    inner = F.struct(*[c.alias(k) for k, c in metrics.items()])
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()], inner.alias("metrics")))


def report_line(name: str, value: Column, digits: int = 4) -> Column:
    """A line of a report: the name and the rounded value; nothing is printed as none."""
    return F.concat(F.lit(f"{name}: "), F.when(value.isNull(), "none").otherwise(F.format_string(f"%.{digits}f", value.cast("double"))))


def dataset_perplexity(results: DataFrame) -> DataFrame:
    """Adds perplexity, the exponential of each version's evaluation loss."""
    return results.withColumn("perplexity", F.exp(F.col("eval_results.eval_loss")))


def health(model_version: str, base_model: str, adapter: str) -> list[Column]:
    return [F.lit("running").alias("status"), F.lit(model_version).alias("model_version"), F.lit(base_model).alias("base_model"), F.lit(adapter).alias("adapter")]
