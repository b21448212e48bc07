import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.canonical import (
    UnsupportedTypeError,
    category_key,
    is_digest,
    row_text,
    struct_json,
)
from riskframe.functions.scalars import logit, status, utc_time, zoned_timestamp
from riskframe.functions.values import measured, text_missing_to_null, to_number
from riskframe.operators import audit, fingerprint, joins, sample, split
from riskframe.operators.audit import DataValidationError, validate_transactions
from riskframe.plans.audit_job import audit_dataset
from riskframe.sources import tables

COLUMNS = "TransactionID long, isFraud int, TransactionDT long, TransactionAmt double"


def transactions(spark, n=40):
    rng = random.Random(1)
    rows = [(1000 + i, int(rng.random() < 0.2), 4211 + 7 * (i // 2), 10.0 + i) for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


def identity(spark, n=25):
    return spark.createDataFrame(
        [(1000 + i, -1.5, "mobile") for i in range(n)],
        "TransactionID long, id_01 double, DeviceType string",
    )


def write_pair(spark, folder, part="train", extra=""):
    folder.mkdir(exist_ok=True)
    lines = ["TransactionID,isFraud,TransactionDT,TransactionAmt,card4,M1"]
    for r in transactions(spark).collect():
        card = "NA" if r.TransactionID % 3 == 0 else "visa"
        lines.append(f"{r.TransactionID},{r.isFraud},{r.TransactionDT},{r.TransactionAmt},{card},T")
    (folder / f"{part}_transaction.csv").write_text("\n".join(lines) + "\n" + extra)
    ids = ["TransactionID,id_01,DeviceType"] + [f"{1000 + i},-1.5,mobile" for i in range(25)]
    (folder / f"{part}_identity.csv").write_text("\n".join(ids) + "\n")


def test_csv_pair_join_sample_and_missing_file(spark, tmp_path):
    write_pair(spark, tmp_path)
    loaded = tables.load_labelled(spark, str(tmp_path)).cache()
    assert loaded.count() == 40 and loaded.filter("id_01 IS NULL").count() == 15
    assert dict(loaded.dtypes)["TransactionID"] == "bigint"
    assert dict(loaded.dtypes)["TransactionAmt"] == "double"
    assert loaded.filter("card4 IS NULL").count() == 13
    first = tables.load_labelled(spark, str(tmp_path), sample_rows=15)
    ids = sorted(r.TransactionID for r in first.collect())
    assert len(ids) == 15 and ids[-1] == 1039 and ids[0] == 1000
    again = tables.load_labelled(spark, str(tmp_path), sample_rows=15)
    assert ids == sorted(r.TransactionID for r in again.collect())
    with pytest.raises(FileNotFoundError):
        tables.load_unlabelled(spark, str(tmp_path))


def test_file_digests_stamps_and_records(spark, tmp_path):
    write_pair(spark, tmp_path)
    found = {r.file_name: r.sha256 for r in tables.file_digests(spark, str(tmp_path)).collect()}
    for name, digest in found.items():
        assert digest == hashlib.sha256((tmp_path / name).read_bytes()).hexdigest()
    stamps = {r.stamp for r in tables.file_stamps(spark, str(tmp_path)).collect()}
    assert len(stamps) == 2 and all(len(s) == 16 for s in stamps)
    (tmp_path / "r.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert tables.read_records(spark, str(tmp_path / "r.jsonl")).count() == 2


def plain_tree(data, block, fan):
    level = [hashlib.sha256(b"leaf:" + data[i : i + block]).hexdigest() for i in range(0, max(len(data), 1), block)]
    while len(level) > 1:
        parts = [level[i : i + fan] for i in range(0, len(level), fan)]
        level = [p[0] if len(p) == 1 else hashlib.sha256(f"node:{','.join(p)}".encode()).hexdigest() for p in parts]
    return hashlib.sha256(f"file:{len(data)}:{level[0]}".encode()).hexdigest()


def test_tree_digests_equal_a_plain_tree_whatever_other_files_are_there(spark, tmp_path):
    sizes = {"empty": 0, "one": 1, "block": 10, "more": 11, "full level": 30, "deep%20é": 1000}
    for name, size in sizes.items():
        (tmp_path / name).write_bytes(bytes(i * 7 % 251 for i in range(size)))
    found = tables.file_tree_digests(spark, str(tmp_path), block_bytes=10, fan=3).collect()
    assert {r.file_name: r.length for r in found} == {k: v for k, v in sizes.items() if v}
    for r in found:
        assert r.sha256 == plain_tree((tmp_path / r.file_name).read_bytes(), 10, 3)
    alone = tables.file_tree_digests(spark, str(tmp_path / "more"), block_bytes=10, fan=3).first()
    assert alone.sha256 == {r.file_name: r.sha256 for r in found}["more"]


def test_tree_digest_of_three_sparse_gigabytes_finds_a_changed_byte(spark, tmp_path):
    size = 3 << 30
    with open(tmp_path / "big", "wb") as big:
        big.truncate(size)
    before = tables.recorded_sources(spark, str(tmp_path))
    with open(tmp_path / "big", "r+b") as big:
        big.seek(size - 5)
        big.write(b"x")
    assert tables.recorded_sources(spark, str(tmp_path)) != before
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a").write_text("1")
    (tmp_path / "a").write_text("2")
    with pytest.raises(ValueError):
        tables.recorded_sources(spark, f"{tmp_path}/{{a,sub/a}}")


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 2**40, 0.5)], "a long, b long, c long, d double")
    assert [k for _, k in tables.narrow_types(df).dtypes] == ["tinyint", "smallint", "bigint", "double"]
    assert dict(tables.narrow_types(df, floats=True).dtypes)["d"] == "float"


def test_validation_rules(spark):
    good = transactions(spark)
    validate_transactions(good, label_col="isFraud")
    broken = [
        good.drop("TransactionAmt"),
        good.withColumn("isFraud", F.lit(2)),
        good.withColumn("isFraud", F.lit(None).cast("int")),
        good.withColumn("TransactionID", F.lit(1).cast("long")),
        good.withColumn("TransactionDT", F.lit(-1).cast("long")),
        good.filter("false"),
        good.drop("isFraud"),
    ]
    for df in broken:
        with pytest.raises(DataValidationError):
            validate_transactions(df, label_col="isFraud")
    no_time = good.withColumn("TransactionDT", F.lit(None).cast("long"))
    validate_transactions(no_time)
    with pytest.raises(DataValidationError):
        validate_transactions(no_time, strict=True)


def test_duplicates_count_missing_keys_as_one(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert df.agg(audit.duplicate_count(df, "k").alias("d")).first().d == 2


def test_values_keep_missing_invalid_and_finite_apart(spark):
    rows = [("10",), (" 2.5e1 ",), ("1d",), ("1.5f",), ("inf",), ("nan",), ("1_000",), ("true",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.n for r in df.select(to_number(F.col("s"), T.StringType()).alias("n")).collect()]
    assert got == [10.0, 25.0, None, None, float("inf"), None, None, None, None]
    state = [r.m for r in df.select(measured(F.col("s"), T.StringType()).alias("m")).collect()]
    assert state[-1] is None and all(np.isnan(v) for v in state[2:8])
    cleaned = text_missing_to_null(spark.createDataFrame([("NA",), ("x",), ("",)], "s string"))
    assert [r.s for r in cleaned.collect()] == [None, "x", None]


def test_split_sizes_order_and_disjointness(spark):
    df = transactions(spark, 101).repartition(5)
    rows = split.temporal_split(df, "TransactionDT", "TransactionID").collect()
    ordered = [r.split for r in sorted(rows, key=lambda r: (r.TransactionDT, r.TransactionID))]
    assert ordered == ["train"] * 71 + ["validation"] * 15 + ["test"] * 15
    five = split.five_way_split(df, "TransactionDT", "TransactionID")
    sizes = {r.split: r["count"] for r in five.groupBy("split").count().collect()}
    assert sizes == {
        "train": 71,
        "calibration_fit": 4,
        "selection_validation": 4,
        "promotion_evaluation": 7,
        "final_test": 15,
    }
    assert joins.overlapping_keys(five, "TransactionID", "split").isEmpty()
    summary = audit.split_summary(five, "split", "TransactionDT", "isFraud")
    assert audit.time_overlaps(summary, "split").filter("overlaps").isEmpty()
    hidden = audit.reserve_columns(summary, "split", "final_test").filter("reserved").first()
    assert hidden.row_count == 15 and hidden.positives is None
    with pytest.raises(ValueError):
        split.two_way_split(df.limit(1), "TransactionDT", "TransactionID")
    with pytest.raises(ValueError):
        split.split_table(df, "other", "TransactionDT", "TransactionID", "isFraud")


def test_full_data_split_sizes():
    assert dict(split.five_way_sizes(590_540)) == {
        "train": 413_378,
        "calibration_fit": 22_145,
        "selection_validation": 22_145,
        "promotion_evaluation": 44_291,
        "final_test": 88_581,
    }


def test_stratified_split_and_fallback(spark):
    df = transactions(spark, 400)
    ratios, names = (0.7, 0.15, 0.15), ("train", "validation", "test")
    out = split.stratified_split(df, "TransactionID", "isFraud", ratios, names, 3)
    rates = out.groupBy("split").agg(F.avg("isFraud").alias("r"), F.count("*").alias("n")).collect()
    overall = df.agg(F.avg("isFraud")).first()[0]
    assert {r.split for r in rates} == set(names)
    assert all(abs(r.r - overall) < 0.05 for r in rates)
    single = df.withColumn("isFraud", F.lit(0))
    parts = split.stratified_split(single, "TransactionID", "isFraud", ratios, names, 3)
    assert {r.split: r["count"] for r in parts.groupBy("split").count().collect()} == {
        "train": 280,
        "validation": 60,
        "test": 60,
    }


@pytest.mark.parametrize("total,size", [(10, 3), (1000, 7), (997, 996), (500, 1), (50, 49)])
def test_systematic_grid_matches_even_spacing(spark, total, size):
    got = spark.range(total).filter(sample.on_grid(F.col("id"), total, size)).collect()
    want = np.unique(np.linspace(0, total - 1, num=size, dtype=np.int64))
    assert sorted(r.id for r in got) == want.tolist()


def test_samples(spark):
    df = transactions(spark, 200)
    for strategy in ("time_ordered", "random"):
        args = (strategy, "TransactionDT", "TransactionID")
        once = sorted(r.TransactionID for r in sample.sample_table(df, *args, 30, 5).collect())
        again = sorted(
            r.TransactionID for r in sample.sample_table(df.repartition(9), *args, 30, 5).collect()
        )
        assert len(once) == 30 and once == again
        assert sample.sample_table(df, *args, None).count() == 200
        with pytest.raises(ValueError):
            sample.sample_table(df, *args, 0)
    other = sample.sample_table(df, "random", "TransactionDT", "TransactionID", 30, 6)
    assert sorted(r.TransactionID for r in other.collect()) != once


def test_joins_and_coverage(spark):
    t, i = transactions(spark), identity(spark)
    assert joins.attach_identity(t, i, "TransactionID").count() == 40
    row = joins.key_coverage(t, i, "TransactionID").first()
    assert (row.transaction_keys, row.matched_keys, row.orphan_keys) == (40, 25, 0)
    extra = i.unionByName(i.limit(1).withColumn("TransactionID", F.lit(9).cast("long")))
    assert [r.TransactionID for r in joins.orphan_keys(extra, t, "TransactionID").collect()] == [9]
    assert joins.same_rows(t, t.repartition(3)) and not joins.same_rows(t, t.limit(39))
    assert not joins.same_rows(t, t.withColumn("TransactionAmt", F.col("TransactionAmt") + 1))
    differences = {r.column_name: r.only_in for r in joins.column_differences(t, i).collect()}
    assert differences["isFraud"] == "left" and differences["id_01"] == "right"


def test_fingerprints(spark):
    df = transactions(spark, 60)

    def digest(frame, **kw):
        return fingerprint.table_fingerprint(frame, **kw).first().fingerprint

    base = digest(df)
    for parts in (1, 7, 31):
        assert digest(df.repartition(parts).orderBy(F.desc("TransactionID"))) == base
    changed = df.withColumn(
        "TransactionAmt",
        F.when(F.col("TransactionID") == 1003, 0.0).otherwise(F.col("TransactionAmt")),
    )
    assert digest(changed) != base
    assert digest(df.unionByName(df.limit(1))) != base
    assert digest(df.withColumnRenamed("TransactionAmt", "Amount")) != base
    assert digest(df.withColumn("isFraud", F.col("isFraud").cast("double"))) == base
    ordered = fingerprint.ordered_fingerprint(df, "TransactionDT", "TransactionID").first()
    shuffled = fingerprint.ordered_fingerprint(
        df.repartition(9), "TransactionDT", "TransactionID"
    ).first()
    assert ordered == shuffled
    by_amount = fingerprint.ordered_fingerprint(
        df.withColumn("o", -F.col("TransactionDT")), "o", "TransactionID", df.columns
    ).first()
    assert by_amount.fingerprint != ordered.fingerprint
    with pytest.raises(UnsupportedTypeError):
        digest(df.withColumn("a", F.array(F.lit(1))))


def test_canonical_text_cannot_collide(spark):
    df = spark.createDataFrame(
        [("a|string:1:b", None), ("a", "b"), (None, "ab"), ("", None), (None, "")],
        "x string, y string",
    )
    texts = [r.t for r in df.select(row_text(df.schema, ["x", "y"]).alias("t")).collect()]
    assert len(set(texts)) == 5
    numbers = spark.createDataFrame([(1, 1.0, float("nan"))], "i int, d double, n double")
    keys = numbers.select(
        category_key(F.col("i"), T.IntegerType()).alias("i"),
        category_key(F.col("d"), T.DoubleType()).alias("d"),
        category_key(F.col("n"), T.DoubleType()).alias("n"),
    ).first()
    assert keys.i == keys.d and keys.n is None
    line = numbers.select(struct_json("i", F.lit(None).cast("int").alias("z")).alias("j")).first().j
    assert json.loads(line) == {"i": 1, "z": None}


def test_scalars(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:00Z",), ("2024-01-01T02:00:00+02:00",), ("2024-01-01T00:00:00",)],
        "t string",
    )
    got = [r.t for r in df.select(zoned_timestamp(F.col("t")).alias("t")).collect()]
    assert got[0] == got[1] and got[2] is None
    with pytest.raises(ValueError):
        utc_time("2024-01-01")
    row = (
        spark.range(1)
        .select(
            status(F.lit(0.1), F.lit(0.1), F.lit(0.2)).alias("warn"),
            status(F.lit(0.2), F.lit(0.1), F.lit(0.2)).alias("breach"),
            status(F.lit(None).cast("double"), F.lit(0.1), F.lit(0.2)).alias("none"),
            logit(F.lit(0.0)).alias("low"),
            is_digest(F.lit("0" * 64)).alias("d"),
        )
        .first()
    )
    assert (row.warn, row.breach, row.none, row.d) == ("WARN", "BREACH", "NOT_EVALUATED", True)
    assert row.low == pytest.approx(np.log(1e-7 / (1 - 1e-7)))


def test_dataset_audit(spark):
    def audit(labelled_ids, other_ids):
        unlabelled = transactions(spark).drop("isFraud")
        return audit_dataset(
            (transactions(spark), labelled_ids),
            (unlabelled, other_ids),
            "TransactionID",
            "TransactionDT",
            "isFraud",
            {"t": "1"},
        )

    report = audit(identity(spark), identity(spark, 10))
    assert {n: t["rows"] for n, t in report["tables"].items()} == {
        "labelled transactions": 40,
        "labelled identity": 25,
        "unlabelled transactions": 40,
        "unlabelled identity": 10,
    }
    shares = {part: c["coverage"] for part, c in report["coverage"].items()}
    assert shares == {"labelled": pytest.approx(25 / 40), "unlabelled": pytest.approx(10 / 40)}
    assert set(report["splits"]) == set(split.FIVE_WAY)
    digests = {s["ordered_fingerprint"] for s in report["splits"].values()}
    assert len(digests) == 5
    orphan = identity(spark).withColumn("TransactionID", F.col("TransactionID") + 100000)
    repeated = identity(spark).unionByName(identity(spark))
    for bad in (orphan, repeated):
        for sides in ((bad, identity(spark)), (identity(spark), bad)):
            with pytest.raises(DataValidationError):
                audit(*sides)


def test_records_are_counted_not_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"two\nlines"\n2,x\n')
    read = spark.read.option("multiLine", True).option("header", True).csv(str(tmp_path / "t.csv"))
    assert tables.count_rows(read) == 2
