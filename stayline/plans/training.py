"""The training pipeline over one customer snapshot, step by step, each step built once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.columns import KEY, METRICS, SEED
from stayline.operators import explain, models
from stayline.operators.balance import smote
from stayline.operators.cleaning import clean
from stayline.operators.evaluate import model_metrics, select_best
from stayline.operators.features import FeatureSpec, assemble, feature_frame, fit_levels, fit_scaler, scale
from stayline.operators.split import stratified_split
from stayline.session import new_path, once
from stayline.sources import artifacts
from stayline.sources.snapshot import snapshot, snapshot_files
from stayline.sources.store import Store, file_status


@dataclass
class Pipeline:
    """Clean, encode, split, scale, balance, train, evaluate, select, explain.

    Steps are lazy. Their tables and models are kept in a store by content: every later step and every pass of a
    learner reads a finished table instead of repeating the plan behind it, and another application that asks for the
    same input, settings and code finds them there and fits nothing.
    """

    customers: DataFrame
    settings: dict = field(default_factory=dict)  # arguments of ``models.estimators``
    seed: int = SEED
    fit_rows: int | None = None  # all training rows are used to fit, unless a caller asks for a draw of so many
    inputs: Sequence[str] = ()  # files that ``customers`` comes from; those it reads itself, if not given
    search: dict = field(default_factory=dict)  # what the neighbour search compared

    @property
    def spark(self) -> SparkSession:
        return self.customers.sparkSession

    @cached_property
    def store(self) -> Store:
        settings = {**self.settings, "seed": self.seed, "fit_rows": self.fit_rows}
        return Store(self.spark, self.inputs or self.customers.inputFiles(), settings)

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean(self.customers)

    @cached_property
    def spec(self) -> FeatureSpec:
        return FeatureSpec(fit_levels(self.customers))

    @cached_property
    def prepared(self) -> DataFrame:
        """Key, class, label, raw features and the test flag."""
        return self.store.table("prepared", lambda: stratified_split(
            feature_frame(self.cleaned, self.spec), "label", 0.2, self.seed))

    @cached_property
    def scaler(self) -> DataFrame:
        return self.store.table("scaler", lambda: fit_scaler(self.prepared.where("not is_test")))

    @property
    def scaled(self) -> DataFrame:
        """A projection of ``prepared`` with the one-row scaler; not stored."""
        return scale(self.prepared, self.scaler)

    @property
    def train(self) -> DataFrame:
        return self.scaled.where("not is_test")

    @property
    def test(self) -> DataFrame:
        return self.scaled.where("is_test")

    @cached_property
    def n_train(self) -> int:
        return self.prepared.where("not is_test").count()

    @property
    def _drawn(self) -> bool:
        return self.fit_rows is not None and self.n_train > self.fit_rows

    @cached_property
    def fit_source(self) -> DataFrame:
        """All training rows; a draw per class by seeded hash only where ``fit_rows`` was given."""
        if not self._drawn:
            return self.train
        return self.store.table("fit-source", lambda: stratified_split(
            self.train.drop("is_test"), "label", self.fit_rows / self.n_train, self.seed + 1
        ).where("is_test").withColumn("is_test", F.lit(False)))

    @cached_property
    def oversampled(self) -> DataFrame:
        """All training rows, oversampled, whatever ``fit_rows`` is."""
        return self.store.table("oversampled", lambda: smote(
            self.train, self.spec.names, seed=self.seed, stats=self.search))

    @cached_property
    def balanced(self) -> DataFrame:
        """The rows used to fit, oversampled."""
        if not self._drawn:
            return self.oversampled
        return self.store.table("balanced", lambda: smote(self.fit_source, self.spec.names, seed=self.seed))

    @cached_property
    def learners(self) -> dict:
        return models.estimators(self.balanced.count(), **self.settings)

    @cached_property
    def fitted(self) -> dict[str, models.Fitted]:
        """Every learner on the rows used to fit, by name."""
        def write(path: str) -> None:
            if "together" in self.__dict__ and "all" in self.together:
                made = self.together["all"]
            else:
                made = models.fit_sets({"all": self.balanced}, self.spec.names, self.learners)["all"]
            artifacts.save_fitted(self.spark, made, path)

        return artifacts.load_fitted(self.spark, self.store.folder("models", write))

    @cached_property
    def _folds(self) -> tuple[dict[str, DataFrame], DataFrame]:
        return models.folded_sets(self.fit_source, self.spec.names, seed=self.seed)

    @cached_property
    def together(self) -> dict[str, dict[str, models.Fitted]]:
        """The folds' models and, unless they exist already, those of all rows: one series of passes."""
        sets = dict(self._folds[0])
        if not self.store.holds("models"):
            sets["all"] = self.balanced
        return models.fit_sets(sets, self.spec.names, self.learners)

    @property
    def models(self) -> dict[str, Model]:
        return {n: f.model for n, f in self.fitted.items()}

    @cached_property
    def scored(self) -> DataFrame:
        """Test rows scored by every model."""
        def test() -> DataFrame:
            return assemble(self.test, self.spec.names).select(KEY, "label", "features")

        return self.store.table("scored", lambda: models.score_all(self.models, test()))

    @cached_property
    def metrics(self) -> DataFrame:
        return self.store.table("metrics", lambda: model_metrics(self.scored))

    @cached_property
    def ranking(self) -> DataFrame:
        return self.store.table("ranking", lambda: select_best(self.metrics, models.MODEL_ORDER))

    @cached_property
    def best_name(self) -> str:
        return self.ranking.where("is_best = 1").first()["model"]

    @cached_property
    def cv_scores(self) -> DataFrame:
        """AUC of every learner in every fold."""
        return self.store.table("cv-scores", lambda: models.fold_aucs(
            {s: m for s, m in self.together.items() if s != "all"}, self._folds[1], self.spec.names))

    @property
    def best_scored(self) -> DataFrame:
        return self.scored.where(F.col("model") == self.best_name)

    def leaves_of(self, name: str) -> list[tuple]:
        """Leaf paths of a tree model, from its node table."""
        model = self.models[name]
        if name != models.FOREST:
            return explain.tree_leaves(model.node_table(self.spark))
        path = new_path(self.spark, "trees")
        model.write().save(path)
        return explain.tree_leaves(explain.forest_nodes(self.spark, path))

    @cached_property
    def background(self) -> list[float]:
        return explain.linear_base(self.train, self.spec.names)

    def explained(self, name: str) -> tuple[DataFrame, float]:
        """Attributions (key, x, phi) of one model over the test rows, and the value they start from.

        A forest is explained on the probability, boosted trees and logistic regression on the log-odds.
        """
        if name == models.LOGISTIC:
            model = self.models[name]
            coefs = model.coefficients.toArray().tolist()
            base = model.intercept + sum(c * m for c, m in zip(coefs, self.background))
            return explain.shap_linear(self.test, self.spec.names, coefs, self.background), base
        leaves = self.leaves_of(name)
        test = assemble(self.test, self.spec.names).select(KEY, "features")
        cores = self.spark.sparkContext.defaultParallelism
        start = 0.0 if name == models.FOREST else self.models[name].base
        return explain.shap_tree(test, leaves, partitions=cores), start + explain.tree_base(leaves)

    @cached_property
    def explanation(self) -> tuple[DataFrame, float]:
        """``explained`` for the selected model, stored as one row with two arrays per customer."""
        found: dict[str, float] = {}

        def build() -> DataFrame:
            rows, found["base"] = self.explained(self.best_name)
            return rows

        rows = self.store.table("shap", build)
        return rows, self.store.value("shap-base", lambda: found or {"base": self.explained(self.best_name)[1]})["base"]

    @property
    def shap(self) -> DataFrame:
        """Rows (key, feature, feature_value, shap) of the selected model."""
        return explain.long_form(self.explanation[0], self.spec.names)

    @cached_property
    def importance(self) -> DataFrame:
        return explain.importance(self.shap)

    def report(self) -> DataFrame:
        """Final findings as rows (section, item, value)."""
        cv_scores = self.cv_scores  # first, so that folds and all rows are fitted in one series of passes
        sizes = self.prepared.groupBy("is_test").agg(F.count(F.lit(1)).alias("value")).select(
            F.lit("rows").alias("section"), F.when(F.col("is_test"), "test").otherwise("train").alias("item"),
            F.col("value").cast("double").alias("value"),
        )
        balance = self.balanced.groupBy("label").agg(F.count(F.lit(1)).alias("value")).select(
            F.lit("balanced rows").alias("section"), F.concat(F.lit("class "), F.col("label")).alias("item"),
            F.col("value").cast("double").alias("value"),
        )
        table = self.metrics.unpivot(["model"], METRICS, "metric", "value").select(
            F.col("model").alias("section"), F.col("metric").alias("item"), "value"
        )
        composite = self.ranking.select(F.lit("composite").alias("section"), F.col("model").alias("item"),
                                        F.col("composite").alias("value"))
        cv = models.cv_summary(cv_scores).where(F.col("model") == self.best_name).selectExpr(
            "'cross validation' as section", "stack(2, 'mean', cv_mean, 'deviation', cv_std) as (item, value)")
        return sizes.unionByName(balance).unionByName(table).unionByName(composite).unionByName(cv)


def pipeline(spark: SparkSession, sf_dir: str, **settings) -> Pipeline:
    """The pipeline over a data folder. One application builds it once for what the files hold."""
    inputs = snapshot_files(sf_dir)
    key = ("pipeline", tuple(file_status(spark, inputs)), tuple(sorted(settings.items())))
    return once(spark, key, lambda: Pipeline(snapshot(spark, sf_dir), settings, inputs=inputs))
