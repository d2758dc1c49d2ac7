"""Feature views, frozen datasets, run log and model versions, all as ordinary tables.

A store is a folder: Parquet snapshots under ``views/``, ``datasets/`` and ``models/``, and one
append-only Parquet table per kind of record under ``records/``. Every read and write is a Spark
job; no service is involved.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.functions.columns import as_column
from ratewright.operators.diagnostics import PREDICTED
from ratewright.operators.features import FeaturePlan
from ratewright.operators.models import Fit
from ratewright.sources import claims
from ratewright.sources.feeds import write_predictions_feed

RECORDS = {
    "feature_views": "name string, version string, keys array<string>, columns array<string>, path string, "
    "description string, rows long, created_at timestamp",
    "datasets": "name string, version string, path string, columns array<string>, keys array<string>, "
    "labels array<string>, feature_view string, feature_view_version string, description string, rows long, "
    "created_at timestamp, row_digest string, key_digest string",
    "run_params": "experiment string, run string, param string, value string, logged_at timestamp",
    "run_metrics": "experiment string, run string, metric string, step int, value double, logged_at timestamp",
    "run_artifacts": "experiment string, run string, path string, logged_at timestamp",
    "model_versions": "model string, version string, path string, description string, comment string, "
    "metrics map<string,double>, sample_path string, experiment string, run string, dataset string, "
    "dataset_version string, attachments array<string>, created_at timestamp",
    "model_defaults": "model string, version string, logged_at timestamp",
}


class AlreadyExists(ValueError):
    """A frozen name and version is never written twice."""


def entity_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys repeat, and how many rows miss part of their key."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.count_if((F.col("n") > 1) & ~missing).alias("DUPLICATE_KEYS"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("NULL_KEY_ROWS"),
        F.count_if(~missing).alias("ENTITIES"),
    )


def spine_join(spine: DataFrame, view: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every spine row with the features of its entity; spine columns come first."""
    clash = [c for c in view.columns if c in spine.columns and c not in keys]
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")
    return spine.join(view, list(keys), "left").select(*spine.columns, *[c for c in view.columns if c not in keys])


class PricingStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- records -------------------------------------------------------------------------------

    def records(self, kind: str) -> DataFrame:
        try:
            return self.spark.read.schema(RECORDS[kind]).parquet(f"{self.root}/records/{kind}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RECORDS[kind])

    def _append(self, kind: str, rows: Sequence[tuple]) -> None:
        table = self.spark.createDataFrame(list(rows), RECORDS[kind]).coalesce(1)
        table.write.mode("append").parquet(f"{self.root}/records/{kind}")

    def _one(self, kind: str, **match):
        rows = self.records(kind)
        for column, value in match.items():
            rows = rows.where(F.col(column) == value)
        return rows.orderBy(F.desc("created_at")).first()

    @contextmanager
    def _claimed(self, kind: str, name: str, version: str) -> Iterator[str]:
        """Hold a name and version that nobody else has; gives a folder of its own for the data. A write that fails
        gives them back."""
        claim = claims.claim_path(self.root, kind, name, version)
        if not claims.take(self.spark, claim):
            raise AlreadyExists(f"{kind}: {name} version {version}")
        try:
            yield f"{self.root}/{kind}/name={name}/version={version}/at={stamp()}"
        except BaseException:
            claims.release(self.spark, claim)
            raise

    def abandon(self, kind: str, name: str, version: str) -> None:
        """Free a claim (``datasets`` or ``models``) whose writer died before it wrote its record."""
        recorded = (
            self._one("datasets", name=name, version=version)
            if kind == "datasets"
            else self._one("model_versions", model=name, version=version)
        )
        if recorded is not None:
            raise AlreadyExists(f"{kind}: {name} version {version}")
        claims.release(self.spark, claims.claim_path(self.root, kind, name, version))

    # -- feature views and datasets ------------------------------------------------------------

    def register_view(
        self,
        df: DataFrame,
        name: str,
        version: str,
        keys: Sequence[str] = ("POLICY_ID",),
        description: str = "",
        overwrite: bool = True,
    ) -> DataFrame:
        """Materialise a feature table under a version after checking its entity key."""
        if not overwrite and self._one("feature_views", name=name, version=version):
            raise AlreadyExists(f"feature view {name} version {version}")
        path = f"{self.root}/views/name={name}/version={version}/at={stamp()}"
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        check = entity_check(stored, keys).first()
        if check["DUPLICATE_KEYS"] or check["NULL_KEY_ROWS"]:
            raise ValueError(
                f"{name}: {check['DUPLICATE_KEYS']} repeated keys, {check['NULL_KEY_ROWS']} rows without a key"
            )
        self._append(
            "feature_views",
            [(name, version, list(keys), stored.columns, path, description, check["ENTITIES"], _now())],
        )
        return stored

    def has_view(self, name: str, version: str) -> bool:
        return self._one("feature_views", name=name, version=version) is not None

    def has_dataset(self, name: str, version: str) -> bool:
        return self._one("datasets", name=name, version=version) is not None

    def view(self, name: str, version: str) -> DataFrame:
        record = self._one("feature_views", name=name, version=version)
        if record is None:
            raise KeyError(f"no feature view {name} version {version}")
        return self.spark.read.parquet(record["path"])

    def generate_dataset(
        self,
        spine: DataFrame,
        name: str,
        version: str,
        view: str,
        view_version: str,
        labels: Sequence[str] = ("PURE_PREMIUM", "EXPOSURE"),
        description: str = "",
        key_filter: Column | None = None,
    ) -> DataFrame:
        """Freeze spine rows joined with their features. A version is written once, never again: of two writers at
        once, one gets AlreadyExists before it writes. The record keeps digests of the rows, taken while they are
        written; ``audit_datasets`` proves them.

        ``key_filter``, a condition on the key that every spine row meets, keeps the view's other
        rows out of the join.
        """
        if self._one("datasets", name=name, version=version):
            raise AlreadyExists(f"dataset {name} version {version}")
        record = self._one("feature_views", name=view, version=view_version)
        if record is None:
            raise KeyError(f"no feature view {view} version {view_version}")
        keys = record["keys"]
        features = self.spark.read.parquet(record["path"])
        if key_filter is not None:
            features = features.where(key_filter)
        joined = spine_join(spine, features, keys)
        with self._claimed("datasets", name, version) as path:
            written = Observation()
            rows = claims.marked(joined, keys).observe(written, *claims.digests())
            rows.drop(claims.ROW_BITS, claims.KEY_BITS).write.parquet(path)
            seen = written.get
            self._append(
                "datasets",
                [
                    (name, version, path, joined.columns, list(keys), list(labels), view, view_version, description)
                    + (seen["rows"], _now(), seen["row_digest"], seen["key_digest"])
                ],
            )
        return self.spark.read.parquet(path)

    def audit_datasets(self) -> DataFrame:
        """A row per frozen version: name, version, ROWS and KEY_DIGEST as stored now, and INTACT, whether row count
        and both digests equal the record (NULL if it has none). One pass over each version."""
        result = None
        for record in self.records("datasets").collect():  # a row per version
            stored = self.spark.read.parquet(record["path"]).select(*[f"`{c}`" for c in record["columns"]])
            same = (
                (F.col("rows") == record["rows"])
                & (F.col("row_digest") == F.lit(record["row_digest"]))
                & (F.col("key_digest") == F.lit(record["key_digest"]))
            )
            form = claims.form_of(record["row_digest"])
            row = claims.marked(stored, record["keys"], form).agg(*claims.digests(form)).select(
                F.lit(record["name"]).alias("name"),
                F.lit(record["version"]).alias("version"),
                F.col("rows").alias("ROWS"),
                F.col("key_digest").alias("KEY_DIGEST"),
                same.alias("INTACT"),
            )
            result = row if result is None else result.unionByName(row)
        schema = "name string, version string, ROWS long, KEY_DIGEST string, INTACT boolean"
        return self.spark.createDataFrame([], schema) if result is None else result

    def load_dataset(self, name: str, version: str, only_features: bool = False) -> DataFrame:
        """The exact rows of a version; ``only_features`` drops the label columns."""
        record = self._one("datasets", name=name, version=version)
        if record is None:
            raise KeyError(f"no dataset {name} version {version}")
        stored = self.spark.read.parquet(record["path"]).select(*record["columns"])
        return stored.drop(*record["labels"]) if only_features else stored

    # -- runs ----------------------------------------------------------------------------------

    def log_params(self, experiment: str, run: str, params: Mapping) -> None:
        now = _now()
        self._append("run_params", [(experiment, run, k, str(v), now) for k, v in params.items()])

    def log_metrics(self, experiment: str, run: str, values: Mapping[str, float], step: int = 0) -> None:
        now = _now()
        self._append(
            "run_metrics", [(experiment, run, k, step, None if v is None else float(v), now) for k, v in values.items()]
        )

    def log_metric_table(
        self, experiment: str, table: DataFrame, run: str | Column, metrics: Sequence[str], step: str | None = None
    ) -> None:
        """Append the metric columns of a result table; ``run`` (and ``step``, say the boosting
        round) say where each row belongs. Values go from table to table."""
        entries = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        )
        at = F.lit(0) if step is None else F.col(step).cast("int")
        rows = table.select(as_column(run).alias("run"), at.alias("step"), F.inline(entries)).select(
            F.lit(experiment).alias("experiment"),
            "run",
            "metric",
            "step",
            "value",
            F.lit(_now()).cast("timestamp").alias("logged_at"),
        )
        rows.write.mode("append").parquet(f"{self.root}/records/run_metrics")

    def log_artifacts(self, experiment: str, run: str, paths: Sequence[str]) -> None:
        now = _now()
        self._append("run_artifacts", [(experiment, run, p, now) for p in paths])

    def compare_runs(self, experiment: str, metrics: Sequence[str]) -> DataFrame:
        """One row per run, one column per metric: of the latest logging, the value of its highest step."""
        rows = self.records("run_metrics").where(F.col("experiment") == experiment)
        return (
            rows.where(F.col("metric").isin(list(metrics)))
            .groupBy("run")
            .pivot("metric", list(metrics))
            .agg(F.max_by("value", F.struct("logged_at", "step")))
        )

    # -- models --------------------------------------------------------------------------------

    def register_model(
        self,
        fit: Fit,
        model: str,
        version: str,
        metrics: Mapping[str, float] | None = None,
        comment: str = "",
        sample: DataFrame | None = None,
        sample_rows: int = 10,
        experiment: str | None = None,
        run: str | None = None,
        dataset: str | None = None,
        dataset_version: str | None = None,
        attachments: Sequence[str] = (),
        make_default: bool = True,
    ) -> None:
        if self._one("model_versions", model=model, version=version):
            raise AlreadyExists(f"model {model} version {version}")
        with self._claimed("models", model, version) as path:
            fit.save(f"{path}/fit")
            sample_path = None
            if sample is not None:
                sample_path = f"{path}/sample_input"
                sample.select(*fit.features).limit(sample_rows).write.parquet(sample_path)
            values = {k: float(v) for k, v in (metrics or {}).items()}
            self._append(
                "model_versions",
                [
                    (model, version, f"{path}/fit", fit.describe(), comment, values, sample_path, experiment, run)
                    + (dataset, dataset_version, list(attachments), _now())
                ],
            )
        if make_default:
            self.set_default(model, version)

    def set_default(self, model: str, version: str) -> None:
        if self._one("model_versions", model=model, version=version) is None:
            raise KeyError(f"no model {model} version {version}")
        self._append("model_defaults", [(model, version, _now())])

    def model_versions(self) -> DataFrame:
        """All versions, the default of each model marked."""
        latest = Window.partitionBy("model").orderBy(F.desc("logged_at"), F.desc("version"))
        defaults = (
            self.records("model_defaults")
            .withColumn("n", F.row_number().over(latest))
            .where("n = 1")
            .select("model", "version", F.lit(True).alias("is_default"))
        )
        versions = self.records("model_versions").join(defaults, ["model", "version"], "left")
        return versions.withColumn("is_default", F.coalesce("is_default", F.lit(False)))

    def get_model(self, model: str, version: str | None = None) -> Fit:
        """A registered version, or the model's default."""
        record = self._model_record(model, version)
        return Fit.load(record["path"], record["description"])

    def _model_record(self, model: str, version: str | None):
        rows = self.model_versions().where(F.col("model") == model)
        rows = rows.where("is_default") if version is None else rows.where(F.col("version") == version)
        record = rows.first()
        if record is None:
            raise KeyError(f"no model {model} version {version or '(default)'}")
        return record

    def feature_plan(self, model: str, version: str | None = None) -> FeaturePlan:
        """The fitted plan behind the dataset that a model version (or the default) was trained on."""
        record = self._model_record(model, version)
        dataset = self._one("datasets", name=record["dataset"], version=record["dataset_version"])
        if dataset is None:
            raise KeyError(f"model {model} names no dataset")
        view = self._one("feature_views", name=dataset["feature_view"], version=dataset["feature_view_version"])
        return FeaturePlan.from_json(view["description"])

    def score_batch(self, fit: Fit, features: DataFrame, path: str) -> DataFrame:
        """Score a frame of features, replace the Parquet table at ``path`` and return its scan. A frame without
        a feature of the model, or with one that is not a number, is refused before anything is written."""
        absent = [f for f in fit.features if f not in features.columns]
        if absent:
            raise ValueError(f"input lacks model features: {', '.join(absent)}")
        mistyped = [f for f in fit.features if not isinstance(features.schema[f].dataType, T.NumericType)]
        if mistyped:
            raise ValueError(f"not numeric: {', '.join(mistyped)}")
        fit.predict(features).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


    def export_scores(
        self, model: str, features: DataFrame, path: str, version: str | None = None, key: str = "POLICY_ID"
    ) -> DataFrame:
        """Score a frame with a registered version (or the default), keep the scores as a table below ``path`` and write
        them as an XML feed beside it; returns the scan of the table."""
        scores = self.score_batch(self.get_model(model, version), features, f"{path}/scores")
        scores = scores.select(key, PREDICTED)
        write_predictions_feed(scores, f"{path}/scores.xml")
        return scores


def _now() -> datetime:
    return datetime.now(timezone.utc)


def stamp() -> str:
    return _now().strftime("%Y%m%dT%H%M%S%f")
