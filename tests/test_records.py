import pytest

from riskframe.operators.records import (
    RecordContract,
    issue_table,
    reason_label,
    request_reasons,
    split_records,
    validate_records,
)

CONTRACT = RecordContract(("fee", "age"), ("channel",))
BAD_NUMBER, BAD_CATEGORY, NESTED = "invalid_numeric", "invalid_categorical", "non_scalar_feature"
# One case per rule: what the record holds, and the codes it gets.
CASES = [
    ('{"fee": 12}', []),
    ('{"fee": "  7.5e2 "}', []),
    ('{"age": "12_500"}', []),
    ('{"channel": "pigeon post"}', []),
    ('{"age": null, "channel": "web"}', []),
    ('{"fee": -0.0, "note": ["kept", "out"]}', []),
    ("{}", ["no_usable_features"]),
    ('{"note": 1}', ["no_usable_features"]),
    ('{"age": null}', ["no_usable_features"]),
    ('{"channel": "\\t"}', [BAD_CATEGORY]),
    ('{"channel": false}', [BAD_CATEGORY]),
    ('{"fee": "twelve"}', [BAD_NUMBER]),
    ('{"fee": "3f"}', [BAD_NUMBER]),
    ('{"age": "-Infinity"}', [BAD_NUMBER]),
    ('{"age": " "}', [BAD_NUMBER]),
    ('{"fee": -3e999}', [BAD_NUMBER]),
    ('{"fee": false}', [BAD_NUMBER]),
    ('{"age": []}', [NESTED]),
    ('{"channel": {}}', [NESTED]),
    ('{"age": "?", "channel": 0}', [BAD_NUMBER, BAD_CATEGORY]),
    ('"text"', ["malformed_record"]),
    ('{"fee": 1', ["malformed_record"]),
]


def test_codes_reasons_and_split(spark):
    df = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(CASES)], "record_id long, record string"
    ).repartition(3)
    validated = validate_records(df, CONTRACT).cache()
    found = {r.record_id: [i.code for i in r.issues] for r in validated.collect()}
    assert found == {i: codes for i, (_, codes) in enumerate(CASES)}
    good, bad = split_records(validated)
    assert good.count() == sum(not codes for _, codes in CASES)
    reasons = {r.record_id: r.reason for r in bad.select("record_id", reason_label(bad.issues).alias("reason")).collect()}
    assert reasons[19] == "multiple" and reasons[9] == "invalid_categorical"
    assert reasons[20] == "other"
    grouped = {r.record_id: r.reason for r in request_reasons(issue_table(validated), "record_id").collect()}
    assert grouped == reasons


def test_contract_rules():
    with pytest.raises(ValueError):
        RecordContract((), ())
    with pytest.raises(ValueError):
        RecordContract(("a",), ("a",))
