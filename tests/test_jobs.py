import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators.metrics import compute_metrics
from riskframe.plans.compare import (
    Gates,
    ModelScores,
    compare_models,
    compare_saved_models,
    variant_table,
)
from riskframe.plans.train import (
    RiskModel,
    TrainingConfig,
    final_report,
    run_training,
    smoke_score,
)
from riskframe.operators.drift import fit_reference
from riskframe.operators.contract import Contract
from riskframe.plans.drift_report import run_drift
from riskframe.sources.frozen import (
    EvaluationTableError,
    evidence_identity,
    load_evaluation,
    require_same_sources,
    write_evaluation,
)
from riskframe.sources.sinks import read_json_document, write_json_document, write_json_rows
from riskframe.sources.tables import file_digests, recorded_sources
from riskframe.streaming import monitor
from riskframe.streaming.scoring import score_records, start_scoring

KEYS = ("order_no", "placed", "late")


def orders(spark):
    rows = [(f"o{i:02d}", 1000 - 7 * i, i % 3 == 0, i / 4) for i in range(12)]
    return spark.createDataFrame(rows, "order_no string, placed int, late boolean, price double").select(
        "order_no", "placed", F.col("late").cast("int").alias("late"), "price",
        F.xxhash64("order_no").alias("place_no"),
    )


def sealed(df, folder, **changes):
    options = {
        "data_source": "shop",
        "split_strategy": "random",
        "source_fingerprint": {"orders.csv": "d1"},
        **changes,
    }
    return write_evaluation(df, str(folder), "place_no", "placed", "late", **options)


def test_seals_agree_on_rows_and_disagree_on_any_change(spark, tmp_path):
    first = sealed(orders(spark), tmp_path / "a")
    assert evidence_identity(first) == evidence_identity(
        sealed(orders(spark).orderBy("price").repartition(3), tmp_path / "b")
    )
    assert first["content"]["classes"] == [8, 4] and first["content"]["rows"] == 12
    assert load_evaluation(spark, str(tmp_path / "a")).count() == 12
    dearer = orders(spark).withColumn("price", F.col("price") + 1)
    other = sealed(dearer, tmp_path / "c")
    assert evidence_identity(other) != evidence_identity(first)
    with pytest.raises(EvaluationTableError, match="stored_digest"):
        load_evaluation(spark, str(tmp_path / "c"), first)
    content = {**other["content"], "id_digest": "f" * 64}
    with pytest.raises(EvaluationTableError, match="id_digest"):
        load_evaluation(spark, str(tmp_path / "c"), {**other, "content": content})


def test_unsound_seals_and_rows(spark, tmp_path):
    seal = sealed(orders(spark), tmp_path / "a")
    for part, entry, value in (
        ("about", "role", "final"),
        ("about", "layout", 1),
        ("about", "source_digests", {"orders.csv": ""}),
        ("content", "rows", 0),
        ("content", "ordered_digest", "12"),
        ("content", "digest_kind", None),
    ):
        with pytest.raises(EvaluationTableError, match=entry):
            evidence_identity({**seal, part: {**seal[part], entry: value}})
    with pytest.raises(EvaluationTableError):
        evidence_identity({k: v for k, v in seal.items() if k != "shape"})
    unusable = {
        "twice": orders(spark).unionByName(orders(spark)),
        "labels": orders(spark).withColumn("late", F.lit(3)),
        "empty": orders(spark).limit(0),
        "columns": orders(spark).drop("placed"),
    }
    for name, rows in unusable.items():
        with pytest.raises(EvaluationTableError):
            sealed(rows, tmp_path / name)


def test_source_check_and_strict_json(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\n")
    digests = file_digests(spark, str(tmp_path / "x.csv"))
    recorded = {r.file_name: r.sha256 for r in digests.collect()}
    require_same_sources(recorded, digests)
    with pytest.raises(EvaluationTableError):
        require_same_sources({"x.csv": "0"}, digests)
    with pytest.raises(ValueError):
        write_json_document(spark, {"v": float("nan")}, str(tmp_path / "d"))
    write_json_document(spark, {"b": 1, "a": None}, str(tmp_path / "e"))
    assert read_json_document(spark, str(tmp_path / "e")) == {"a": None, "b": 1}
    rows = spark.createDataFrame([(float("inf"), 1), (float("nan"), None)], "v double, n int")
    write_json_rows(rows, str(tmp_path / "rows"))
    text = spark.read.text(str(tmp_path / "rows")).collect()
    assert all(json.loads(r.value)["v"] is None for r in text)


def two_models(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.3).astype(int)
    good = np.clip(0.5 * y + 0.5 * rng.random(400), 0, 1)
    rows = [(int(a), float(b), float(c)) for a, b, c in zip(y, good, rng.random(400))]
    return spark.createDataFrame(rows, "y int, good double, random double")


def test_comparison_gates_and_blocking(spark):
    df = two_models(spark)
    good, bad = ModelScores("good", "good", 0.5), ModelScores("bad", "random", 0.5)
    report = compare_models(df, "y", good, bad, champion_frozen=df.select("y", "good"))
    assert report["decision"] == "candidate_at_least_as_good"
    assert report["diff"]["pr_auc"] > 0 and set(report["metrics"]) == {"good", "bad"}
    worse = compare_models(df, "y", bad, good)
    assert worse["decision"] == "candidate_worse"
    alone = compare_models(df, "y", good)
    assert alone["decision"] == "promote_candidate_no_champion" and alone["diff"] == {}
    decided = df.withColumn("d", (F.col("good") >= 0.5).cast("int")).withColumn("t", F.lit(0.5))
    own = ModelScores("good", "good", 0.5, decision_col="d", threshold_col="t")
    assert compare_models(decided, "y", own, bad)["decision"] == "candidate_at_least_as_good"
    strict = compare_models(df, "y", good, gates=Gates(min_recall=1.1))
    assert strict["decision"] == "candidate_worse"
    for broken in (
        compare_models(df.filter("y = 1"), "y", good, bad),
        compare_models(df.withColumn("good", F.lit(float("nan"))), "y", good, bad),
        compare_models(df, "y", good, ModelScores("bad", "random", 0.5, fn_cost=1.0)),
        compare_models(df, "y", good, bad, evidence=({"f": 1}, {"f": 2})),
        compare_models(df, "y", good, bad, champion_frozen=df.select("y", "good").limit(399)),
        compare_models(decided.withColumn("d", 1 - F.col("d")), "y", own, bad),
        compare_models(decided.withColumn("t", F.lit(0.6)), "y", own, bad),
        compare_models(df.withColumn("y", F.lit(None).cast("int")), "y", good, bad),
    ):
        assert broken["decision"] == "blocked" and broken["reason"]
    with pytest.raises(ValueError):
        ModelScores("m", "good", 1.5)
    long = df.select("y", F.lit("v").alias("variant"), F.col("good").alias("s"))
    assert variant_table(long, "y", "variant", "s", 0.5).count() == 1


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    n = 900
    amount, kind = rng.gamma(2.0, 30.0, n), rng.integers(0, 3, n)
    chance = 1 / (1 + np.exp(-(amount - 90) / 15 - (kind == 2)))
    y = (rng.random(n) < chance).astype(int)
    rows = [
        (
            i,
            i * 10,
            float(amount[i]) if i % 9 else None,
            "abc"[kind[i]] if i % 7 else None,
            f"u{i % 60}",
            int(y[i]),
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(
        rows,
        "TransactionID long, TransactionDT long, TransactionAmt double, card string, user string, "
        "isFraud int",
    )
    config = TrainingConfig(
        trees=4,
        depth=3,
        learning_rate=0.3,
        calibration="sigmoid",
        max_distinct=20,
        categorical_strategy="frequency_high_cardinality",
    )
    folder = tmp_path_factory.mktemp("model")
    (folder / "sources").mkdir()
    (folder / "sources" / "file").write_text("the rows")
    noted = recorded_sources(df.sparkSession, str(folder / "sources"))
    result = run_training(df, config, noted, str(folder / "evaluation"))
    result.model.save(str(folder / "saved"))
    return df, config, result, folder


def test_training_end_to_end(spark, trained):
    df, config, result, folder = trained
    assert result.selection_metrics["roc_auc"] > 0.6
    assert result.model.schema.frequency == ("user",)
    assert result.record["used_rows"]["stopping_and_calibration"]["rows"] == 34
    assert result.manifest["content"]["rows"] == load_evaluation(spark, str(folder / "evaluation")).count()
    hidden = result.summary.filter("reserved").first()
    assert hidden.split == "final_test" and hidden.positives is None
    source = folder / "sources"
    report = final_report(result.model, df, config, str(source))
    assert report["rows"]["rows"] == 135
    assert 0 <= report["metrics"]["brier_score"] <= 0.3
    other = folder / "other"
    other.mkdir()
    for off in ({"file": "the rowS"}, {"more": "the rows"}, {"file": "the rows", "more": "x"}):
        place = other / str(len(list(other.iterdir())))
        place.mkdir()
        for name, text in off.items():
            (place / name).write_text(text)
        with pytest.raises(EvaluationTableError):
            final_report(result.model, df, config, str(place))
    with pytest.raises(ValueError):
        final_report(result.model, df, config)
    assert 0 <= smoke_score(result.model, spark) <= 1


def test_saved_model_scores_the_same(spark, trained):
    df, _, result, folder = trained
    again = RiskModel.load(spark, str(folder / "saved"))
    keys = ["TransactionID"]
    a = {r.TransactionID: r for r in result.model.score(df, keys).collect()}
    b = {r.TransactionID: r for r in again.score(df, keys).collect()}
    assert a == b and len(a) == 900
    other = result.model.score(df, keys, threshold=0.0).collect()
    assert all(r.fraud_prediction == 1 and r.threshold == 0.0 for r in other)


def test_models_are_scored_inside_the_comparison(spark, trained):
    df, _, result, folder = trained
    evaluation, saved = str(folder / "evaluation"), str(folder / "saved")
    same = compare_saved_models(spark, evaluation, saved, saved)
    assert same["decision"] == "candidate_at_least_as_good" and set(same["diff"].values()) == {0.0}
    rows = load_evaluation(spark, evaluation)
    scored = result.model.score(rows, ["isFraud"])
    want = compute_metrics(scored, "isFraud", "fraud_probability", result.model.threshold).first()
    for name in ("roc_auc", "pr_auc", "f1", "recall"):
        assert same["metrics"]["candidate"][name] == pytest.approx(want[name], abs=1e-12)
    alone = compare_saved_models(spark, evaluation, result.model)
    assert alone["decision"] == "promote_candidate_no_champion"

    class Lying(RiskModel):
        def score(self, df, keep=(), threshold=None):
            told = super().score(df, keep, threshold)
            return told.withColumn("fraud_prediction", 1 - F.col("fraud_prediction"))

    class Failing(RiskModel):
        def score(self, df, keep=(), threshold=None):
            stop = F.raise_error(F.lit("cannot score")).cast("double")
            return super().score(df, keep, threshold).withColumn("fraud_probability", stop)

    fields = {f: getattr(result.model, f) for f in ("preparer", "trees", "calibrator", "threshold", "metadata")}
    lying = compare_saved_models(spark, evaluation, Lying(**fields), saved)
    assert lying["decision"] == "blocked" and "candidate has" in lying["reason"]
    failing = compare_saved_models(spark, evaluation, saved, Failing(**fields))
    assert failing["decision"] == "blocked" and "not scored" in failing["reason"]
    other = dict(fields, metadata={**result.model.metadata, "evaluation": None})
    assert "names no" in compare_saved_models(spark, evaluation, RiskModel(**other))["reason"]
    seal = json.loads(json.dumps(result.model.metadata["evaluation"]))
    seal["about"]["source"] = "elsewhere"
    other = dict(fields, metadata={**result.model.metadata, "evaluation": seal})
    assert "two evaluation tables" in compare_saved_models(spark, evaluation, saved, RiskModel(**other))["reason"]
    assert "not scored" in compare_saved_models(spark, evaluation, str(folder / "nowhere"))["reason"]


def test_stream_scoring_equals_batch(spark, trained, tmp_path):
    df, _, result, _ = trained
    record = F.to_json(F.struct("TransactionAmt", "card", "user", "TransactionDT"))
    texts = df.select(F.col("TransactionID").cast("string").alias("record_id"), record.alias("record"))
    bad = spark.createDataFrame([("bad", '{"card": 5}'), ("empty", "{}")], texts.schema)
    texts = texts.unionByName(bad)
    texts.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in"))
    query = start_scoring(
        stream,
        result.model,
        str(tmp_path / "good"),
        str(tmp_path / "bad"),
        str(tmp_path / "state"),
    )
    query.awaitTermination(180)
    streamed = {r.record_id: r.fraud_probability for r in spark.read.parquet(str(tmp_path / "good")).collect()}
    batch, issues = score_records(texts, result.model)
    assert streamed == {r.record_id: r.fraud_probability for r in batch.collect()}
    rejected = {r.record_id: r.code for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert rejected == {r.record_id: r.code for r in issues.collect()}
    assert rejected == {"bad": "invalid_categorical", "empty": "no_usable_features"}
    direct = {
        str(r.TransactionID): r.fraud_probability
        for r in result.model.score(df, ["TransactionID"]).collect()
    }
    assert streamed == pytest.approx(direct)


def test_stream_counters_equal_batch(spark, tmp_path):
    start = 1_700_000_000
    rows = [(start + 37 * i, int(i % 5 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "s long, flag int").select(
        F.timestamp_seconds("s").alias("ts"), "flag"
    )
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        monitor.prediction_counters(stream, "ts", "flag")
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("counters")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = sorted(spark.sql("SELECT * FROM counters").collect())
    assert got == sorted(monitor.prediction_counters(df, "ts", "flag").collect())
    sizes = [r.b for r in spark.range(0, 502, 50).select(monitor.size_bucket(F.col("id")).alias("b")).collect()]
    assert sizes == [1, 50, 100, 250, 250, 250, 500, 500, 500, 500, 500]


def test_stream_drift_equals_batch(spark, tmp_path):
    contract = Contract(("x",), ("k",), bins=4)
    rows = [(float(i % 17), f"k{i % 4}") for i in range(200)]
    reference = spark.createDataFrame(rows, "x double, k string")
    current = reference.withColumn("x", F.col("x") + 3)
    current.coalesce(1).write.parquet(str(tmp_path / "in"))
    state = fit_reference(reference, contract)
    stream = spark.readStream.schema(current.schema).parquet(str(tmp_path / "in"))
    monitor.start_drift_monitor(
        stream, state, str(tmp_path / "checks"), str(tmp_path / "state")
    ).awaitTermination(180)
    columns = ["check_id", "observed", "status"]
    streamed = spark.read.parquet(str(tmp_path / "checks")).select(columns).collect()
    batch = run_drift(state, current, contract).checks.select(columns).collect()
    assert sorted(streamed) == sorted(batch)
