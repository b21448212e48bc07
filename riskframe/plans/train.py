"""Training and scoring: five-way split, train-fitted preparation, boosted trees, calibration.

The learner is Spark's gradient-boosted trees; they stop on the ROC-AUC of the calibration rows with
patience in rounds.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.values import quoted
from riskframe.operators.audit import reserve_columns, split_summary, validate_transactions
from riskframe.operators.boosting import fit_with_patience
from riskframe.operators.calibrate import Calibrator, fit_calibrator
from riskframe.operators.features import (
    DROP_HIGH_CARDINALITY,
    FeaturePreparer,
    FeaturePreparerModel,
    FeatureSchema,
    infer_schema,
)
from riskframe.operators.fingerprint import ALGORITHM, ordered_fingerprint
from riskframe.operators.metrics import compute_metrics
from riskframe.operators.predict import PROBABILITY_COL, decide
from riskframe.operators.split import TEMPORAL, five_way_random, five_way_split
from riskframe.operators.threshold import select_threshold
from riskframe.session import durable
from riskframe.sources.frozen import require_same_sources, write_evaluation
from riskframe.sources.tables import file_tree_digests
from riskframe.sources.sinks import read_json_document, write_json_document

FEATURES, RAW = "_features", "_raw_probability"


@dataclass(frozen=True)
class TrainingConfig:
    """Defaults of the training job."""

    id_col: str = "TransactionID"
    time_col: str = "TransactionDT"
    label_col: str = "isFraud"
    amount_col: str | None = "TransactionAmt"
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15)
    promotion_share: float = 0.5
    calibration_share: float = 0.5
    categorical_strategy: str = DROP_HIGH_CARDINALITY
    max_distinct: int = 200
    calibration: str = "none"
    threshold_strategy: str = "best_f1"
    fixed_threshold: float = 0.5
    target_recall: float = 0.80
    fn_cost: float = 25.0
    fp_cost: float = 1.0
    trees: int = 500
    depth: int = 5
    learning_rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.9
    patience: int = 20
    exclude: tuple[str, ...] = ()
    split_strategy: str = TEMPORAL
    seed: int = 42


@dataclass(frozen=True)
class RiskModel:
    """Prepared features, trees, calibration and threshold, applied together."""

    preparer: FeaturePreparerModel
    trees: GBTClassificationModel
    calibrator: Calibrator
    threshold: float
    metadata: dict[str, Any] = field(default_factory=dict)

    @property
    def schema(self) -> FeatureSchema:
        return self.preparer.schema

    def raw_scores(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        prepared = self.preparer.prepare(df, keep)
        scored = self.trees.transform(assembler(self.schema).transform(prepared))
        positive = vector_to_array("probability")[1]
        return scored.select(*[quoted(c) for c in keep], positive.alias(RAW))

    def score(
        self, df: DataFrame, keep: Sequence[str] = (), threshold: float | None = None
    ) -> DataFrame:
        """``keep`` columns plus probability, decision and the threshold used."""
        calibrated = self.calibrator.apply(self.raw_scores(df, keep), RAW, PROBABILITY_COL)
        return decide(calibrated.drop(RAW), self.threshold, threshold)

    def save(self, path: str) -> None:
        base = path.rstrip("/")
        self.preparer.write_to(f"{base}/preparer")
        self.trees.save(f"{base}/trees")
        if self.calibrator.isotonic is not None:
            self.calibrator.isotonic.save(f"{base}/isotonic")
        state = {
            "threshold": self.threshold,
            "strategy": self.calibrator.strategy,
            "slope": self.calibrator.slope,
            "intercept": self.calibrator.intercept,
            "metadata": json.loads(json.dumps(self.metadata, default=str)),
        }
        write_json_document(self.preparer.medians.sparkSession, state, f"{base}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RiskModel:
        base = path.rstrip("/")
        state = read_json_document(spark, f"{base}/state")
        isotonic = None
        if state["strategy"] == "isotonic":
            isotonic = IsotonicRegressionModel.load(f"{base}/isotonic")
        return cls(
            FeaturePreparerModel.read_from(spark, f"{base}/preparer"),
            GBTClassificationModel.load(f"{base}/trees"),
            Calibrator(state["strategy"], state["slope"], state["intercept"], isotonic),
            state["threshold"],
            state["metadata"],
        )


def assembler(schema: FeatureSchema) -> VectorAssembler:
    return VectorAssembler(inputCols=list(schema.columns), outputCol=FEATURES)


def fit_trees(prepared: DataFrame, schema: FeatureSchema, config: TrainingConfig):
    """``prepared`` holds features, ``label`` and ``held_out`` for early stopping."""
    learner = GBTClassifier(
        featuresCol=FEATURES,
        labelCol="label",
        maxDepth=config.depth,
        stepSize=config.learning_rate,
        subsamplingRate=config.row_share,
        featureSubsetStrategy=str(config.feature_share),
        seed=config.seed,
    )
    rows = assembler(schema).transform(prepared)
    return fit_with_patience(
        learner, rows.where("not held_out"), rows.where("held_out"), "label", config.trees, config.patience
    )


@dataclass(frozen=True)
class TrainingResult:
    model: RiskModel
    rows: DataFrame
    summary: DataFrame
    selection_metrics: dict[str, Any]
    record: dict[str, Any]
    manifest: dict[str, Any] | None


def partition(df: DataFrame, config: TrainingConfig) -> DataFrame:
    """The five parts by the configured strategy, in ``split``."""
    c = config
    if c.split_strategy == TEMPORAL:
        return five_way_split(
            df, c.time_col, c.id_col, c.ratios, c.promotion_share, c.calibration_share
        )
    return five_way_random(
        df, c.id_col, c.label_col, c.ratios, c.promotion_share, c.calibration_share, c.seed
    )


def run_training(
    df: DataFrame,
    config: TrainingConfig = TrainingConfig(),
    source_fingerprint: dict[str, str] | None = None,
    evaluation_path: str | None = None,
    variant_id: str = "default",
) -> TrainingResult:
    """Split, fit on train, stop and calibrate on held-out rows, choose the threshold on selection."""
    c = config
    validate_transactions(df, c.id_col, c.time_col, c.amount_col, c.label_col)
    rows = partition(df, c)
    summary = reserve_columns(
        split_summary(rows, "split", c.time_col, c.label_col), "split", "final_test"
    )
    parts = {
        name: rows.filter(F.col("split") == name).drop("split")
        for name in ("train", "calibration_fit", "selection_validation", "promotion_evaluation")
    }
    schema = infer_schema(
        parts["train"], (c.id_col, c.label_col, *c.exclude), c.max_distinct, c.categorical_strategy
    )
    preparer = FeaturePreparer(schema).fit(parts["train"])
    development = rows.filter(F.col("split").isin("train", "calibration_fit")).withColumns(
        {
            "label": quoted(c.label_col).cast("double"),
            "held_out": F.col("split") == "calibration_fit",
        }
    )
    # Boosting rereads its input once per tree, so the prepared rows are made durable first.
    prepared = durable(preparer.prepare(development, ["label", "held_out"]))
    trees = fit_trees(prepared, schema, c)
    uncalibrated = RiskModel(preparer, trees, Calibrator("none"), c.fixed_threshold)
    calibrator = fit_calibrator(
        uncalibrated.raw_scores(parts["calibration_fit"], [c.label_col]),
        RAW,
        c.label_col,
        c.calibration,
    )
    draft = RiskModel(preparer, trees, calibrator, c.fixed_threshold)
    selection = durable(draft.score(parts["selection_validation"], [c.label_col]))
    chosen = select_threshold(
        selection,
        c.label_col,
        PROBABILITY_COL,
        c.threshold_strategy,
        c.fixed_threshold,
        c.target_recall,
        c.fn_cost,
        c.fp_cost,
    ).first()
    metrics = compute_metrics(
        selection, c.label_col, PROBABILITY_COL, chosen.threshold, c.fn_cost, c.fp_cost
    ).first()
    source = dict(source_fingerprint or {})
    record = experiment_record(
        variant_id, c, parts["calibration_fit"], parts["selection_validation"], source
    )
    manifest = None
    if evaluation_path is not None:
        manifest = write_evaluation(
            parts["promotion_evaluation"],
            evaluation_path,
            c.id_col,
            c.time_col,
            c.label_col,
            "tables",
            c.split_strategy,
            source,
            c.seed,
        )
    metadata = {
        "config": asdict(c),
        "experiment": record,
        "source_fingerprint": source,
        "evaluation": manifest,
    }
    model = RiskModel(preparer, trees, calibrator, chosen.threshold, metadata)
    return TrainingResult(model, rows, summary, metrics.asDict(), record, manifest)


def row_identity(df: DataFrame, config: TrainingConfig) -> dict[str, Any]:
    row = ordered_fingerprint(df, config.time_col, config.id_col).first()
    return {"rows": row.row_count, "digest": row.fingerprint, "digest_kind": ALGORITHM}


def experiment_record(
    variant_id: str,
    config: TrainingConfig,
    calibration_rows: DataFrame,
    selection_rows: DataFrame,
    source_fingerprint: dict[str, str],
) -> dict[str, Any]:
    """What a variant was, and which rows its calibration and its threshold were fitted on."""
    return {
        "variant": variant_id,
        "settings": {
            "split": config.split_strategy,
            "seed": config.seed,
            "categories": config.categorical_strategy,
            "calibration": config.calibration,
        },
        "sources": dict(source_fingerprint),
        "used_rows": {
            "stopping_and_calibration": row_identity(calibration_rows, config),
            "threshold": row_identity(selection_rows, config),
        },
        "untouched_parts": ["promotion_evaluation", "final_test"],
    }


def final_report(
    model: RiskModel,
    df: DataFrame,
    config: TrainingConfig = TrainingConfig(),
    sources: str | None = None,
) -> dict[str, Any]:
    """Metrics on the reserved part, only for the data the model was trained on.

    The files at the path ``sources`` are read and digested here, block by block, and must be those
    that ``recorded_sources`` noted for the training; without a path there is no report.
    """
    c = config
    recorded = dict(model.metadata.get("source_fingerprint", {}))
    if sources is None:
        raise ValueError("the sources must be digested again for the final report")
    require_same_sources(recorded, file_tree_digests(df.sparkSession, sources))
    rows = partition(df, c)
    final = rows.filter(F.col("split") == "final_test").drop("split")
    scored = durable(model.score(final, [c.label_col]))
    metrics = compute_metrics(
        scored, c.label_col, PROBABILITY_COL, model.threshold, c.fn_cost, c.fp_cost
    ).first()
    return {
        "kind": "last look at the reserved rows; not for choosing between models",
        "sources": recorded,
        "rows": row_identity(final, c),
        "metrics": metrics.asDict(),
    }


def smoke_score(model: RiskModel, spark: SparkSession) -> float:
    """Probability of a record with every field missing; it must be a valid one."""
    probability = model.score(spark.range(1)).first()[PROBABILITY_COL]
    if probability is None or not 0.0 <= probability <= 1.0:
        raise ValueError("an all-missing record has no valid probability")
    return probability
