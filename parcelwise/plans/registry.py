"""Saved models: the fitted pipeline, its feature names and its metadata side by side."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .. import fixed_values as fixed
from ..sources.tabular import write_feature_names

META_SCHEMA = (
    "model_type string, best_params map<string,string>, metrics map<string,map<string,double>>, run_id string, version string"
)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_model(
    spark: SparkSession, model: PipelineModel, path: str, names: list[str], metrics: dict[str, dict[str, float]],
    params: dict, run_id: str | None = None, model_type: str | None = None, version: str = fixed.MODEL_VERSION,
) -> str:
    model.write().overwrite().save(f"{path}/model")
    write_feature_names(spark, names, f"{path}/feature_names")
    kind = model_type or type(model.stages[-1]).__name__
    row = (kind, {k: str(v) for k, v in params.items()}, metrics, run_id, version)
    spark.createDataFrame([row], META_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/model_meta")
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not _exists(spark, f"{path}/model"):
        raise FileNotFoundError(f"No saved model at {path!r}; train one first")
    return PipelineModel.load(f"{path}/model")


def load_meta(spark: SparkSession, path: str) -> DataFrame:
    """The metadata row; raises if no model was saved."""
    if not _exists(spark, f"{path}/model_meta"):
        raise FileNotFoundError(f"No model metadata found at {path!r}; train a model first")
    return spark.read.schema(META_SCHEMA).json(f"{path}/model_meta")


def metrics_table(meta: DataFrame) -> DataFrame:
    """``model_type, version, dataset, metric, value`` out of the nested metrics."""
    from pyspark.sql import functions as F

    per_set = meta.select("model_type", "version", F.explode("metrics").alias("dataset", "scores"))
    return per_set.select("model_type", "version", "dataset", F.explode("scores").alias("metric", "value"))
