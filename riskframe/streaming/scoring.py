"""Scoring of JSON records as they arrive; the same operators as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskframe.operators.records import (
    RecordContract,
    issue_table,
    record_fields,
    split_records,
    validate_records,
)
from riskframe.plans.train import RiskModel


def score_records(
    records: DataFrame,
    model: RiskModel,
    id_col: str = "record_id",
    extra: tuple[str, ...] = (),
    threshold: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Predictions of accepted records, and the issues of rejected ones. Stateless."""
    contract = RecordContract.of(model.schema)
    validated = validate_records(records, contract)
    accepted, _ = split_records(validated)
    fields = record_fields(accepted, contract, [id_col, *extra])
    return model.score(fields, [id_col, *extra], threshold), issue_table(validated, id_col)


def start_scoring(
    records: DataFrame,
    model: RiskModel,
    predictions_path: str,
    rejects_path: str,
    checkpoint: str,
    id_col: str = "record_id",
    extra: tuple[str, ...] = (),
    **trigger,
) -> StreamingQuery:
    """Each micro-batch overwrites its own folder, so a replay after a failure adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Two writes read the batch; kept, its source is read once.
        held = batch.persist()
        try:
            predictions, issues = score_records(held, model, id_col, extra)
            predictions.write.mode("overwrite").parquet(f"{predictions_path}/batch={batch_id}")
            issues.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        finally:
            held.unpersist()

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
