import pytest
from pyspark.sql import functions as F

from riskframe.operators import encode as encode_module
from riskframe.operators import features
from riskframe.operators.features import (
    FREQUENCY_HIGH_CARDINALITY,
    FeaturePreparer,
    FeaturePreparerModel,
    FeatureSchema,
    infer_schema,
)

ROWS = [
    (1, 0, 10.0, 1.0, "a", "id_0"),
    (2, 1, None, 2.0, "b", "id_1"),
    (3, 0, 30.0, float("nan"), None, "id_2"),
    (4, 0, 40.0, 4.0, "a", "id_3"),
    (5, 1, 50.0, 5.0, "b", "id_4"),
    (6, 0, 60.0, 6.0, "c", "id_5"),
]
COLUMNS = (
    "TransactionID long, isFraud int, amount double, count double, category string, "
    "high_card string"
)


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def test_roles(train):
    dropped = infer_schema(train, max_distinct=3)
    assert dropped == FeatureSchema(("amount", "count"), ("category",), (), ("high_card",))
    kept = infer_schema(train, max_distinct=3, strategy=FREQUENCY_HIGH_CARDINALITY)
    assert kept.frequency == ("high_card",) and kept.columns[-1] == "high_card"
    with pytest.raises(ValueError):
        infer_schema(train, strategy="other")


def test_fitted_state_and_unseen_values(spark, train):
    schema = infer_schema(train, max_distinct=3, strategy=FREQUENCY_HIGH_CARDINALITY)
    model = FeaturePreparer(schema).fit(train)
    assert {r.feature: r.median for r in model.medians.collect()} == {"amount": 40.0, "count": 4.0}
    assert {r.value: r.code for r in model.codes.collect()} == {
        "__missing__": 0.0,
        "a": 1.0,
        "b": 2.0,
        "c": 3.0,
    }
    new = spark.createDataFrame(
        [("id_0", "12.5", "z", 1), ("unseen", "bad", None, 2)],
        "high_card string, amount string, category string, extra int",
    )
    first, second = model.prepare(new, keep=["extra"]).orderBy("extra").collect()
    assert (first.amount, first["count"], first.category) == (12.5, 4.0, -1.0)
    assert first.high_card == pytest.approx(1 / 6)
    assert (second.amount, second.category, second.high_card) == (40.0, 0.0, 0.0)
    assert model.transform(new).columns == ["amount", "count", "category", "high_card"]


def test_missing_category_unknown_when_train_had_none(spark):
    train = spark.createDataFrame([("a",), ("b",)], "k string")
    model = FeaturePreparer(FeatureSchema((), ("k",))).fit(train)
    scored = model.transform(spark.createDataFrame([(None,), ("b",)], "k string")).collect()
    assert [r.k for r in scored] == [-1.0, 1.0]


def test_all_missing_record_and_all_null_column(spark, train):
    nulls = train.withColumn("amount", F.lit(None).cast("double"))
    model = FeaturePreparer(infer_schema(nulls, max_distinct=3)).fit(nulls)
    row = model.transform(spark.createDataFrame([(1,)], "nothing int")).first()
    assert row.amount == 0.0 and row["count"] == 4.0 and row.category == 0.0


def test_frequency_of_hot_and_unseen_values(spark):
    rows = [("hot" if i % 3 == 0 else f"v{i}",) for i in range(300)]
    train = spark.createDataFrame(rows, "k string")
    model = FeaturePreparer(FeatureSchema((), (), ("k",))).fit(train)
    new = train.unionByName(spark.createDataFrame([("unseen",), (None,)], "k string"))
    found = sorted(r.k for r in model.transform(new).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = sorted(r.k for r in model.transform(new).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled == found
    assert found[0] == 0.0 and found[-1] == pytest.approx(1 / 3)


def test_saved_model_gives_the_same_rows(spark, train, tmp_path):
    schema = infer_schema(train, max_distinct=3, strategy=FREQUENCY_HIGH_CARDINALITY)
    model = FeaturePreparer(schema).fit(train)
    model.write_to(str(tmp_path / "m"))
    again = FeaturePreparerModel.read_from(spark, str(tmp_path / "m"))
    key = ["TransactionID"]
    assert again.prepare(train, key).orderBy(*key).collect() == model.prepare(train, key).orderBy(
        *key
    ).collect()


def test_codes_of_many_values_are_ranked_in_ranges(spark):
    values = [f"v{i * 7919 % 5000:04d}" for i in range(5000)] + ["ünder", "", "v"]
    df = spark.createDataFrame([(v, "k") for v in values] + [(None, "k")], "a string, b string")
    found = {(r.feature, r.value): r.code for r in features.fit_codes(df, ["a", "b"]).collect()}
    text = sorted(set(values) - {""} | {features.MISSING_CATEGORY} | ({""} if ("a", "") in found else set()), key=str.encode)
    assert [found["a", v] for v in text] == [float(i) for i in range(len(text))]
    assert found["b", "k"] == 0.0


def test_ranges_of_codes_are_even_where_values_begin_alike(spark):
    values = [f"https://example.org/item/{i:05d}" for i in range(20000)]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    codes = features.fit_codes(df, ["a"], ranges=8)
    found = {r.value: r.code for r in codes.collect()}
    assert [found[v] for v in sorted(values)] == [float(i) for i in range(20000)]
    ranged = df.repartitionByRange(8, "a").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranged) == 8 and max(r["count"] for r in ranged) < 2 * 20000 / 8


@pytest.mark.parametrize("held", [True, False])
def test_many_columns_are_encoded_by_one_dictionary(spark, monkeypatch, held):
    if not held:
        monkeypatch.setattr(encode_module, "MOST_HELD", 10)
    names = [f"k.{i}" for i in range(40)]
    rows = [
        tuple(None if (i + j) % 11 == 0 else "hot" if i % 3 == 0 else f"v{i * j % 17}" for j in range(40))
        for i in range(60)
    ]
    train = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    schema = FeatureSchema((), tuple(names[:20]), tuple(names[20:]))
    model = FeaturePreparer(schema).fit(train)
    new = train.unionByName(spark.createDataFrame([("new",) * 40], train.schema))
    prepared = model.prepare(new)
    plan = prepared._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") <= 8
    if held:
        assert "Exchange" not in plan and "Join" not in plan
    codes = {(r.feature, r.value): r.code for r in model.codes.collect()}
    shares = {(r.feature, r.value): r.frequency for r in model.frequencies.collect()}
    want = []
    for row in [*rows, ("new",) * 40]:
        texts = [features.MISSING_CATEGORY if v is None else v for v in row]
        want.append(
            tuple(codes.get((n, t), -1.0) for n, t in zip(names[:20], texts))
            + tuple(shares.get((n, t), 0.0) for n, t in zip(names[20:], texts[20:]))
        )
    assert sorted(tuple(r) for r in prepared.collect()) == sorted(want)
