from __future__ import annotations

import pytest

from cardlake import contracts


def names(domain):
    return contracts.REGISTRY[domain].fieldNames()


def test_equal_sets_pass_in_any_order():
    result = contracts.check_columns(reversed(names("cards")), names("cards"))
    assert result["is_valid"] and result["actual_count"] == 13


def test_missing_and_unexpected_columns_are_listed_sorted():
    actual = [n for n in names("transactions") if n not in ("Amount", "Zip")]
    result = contracts.check_columns([*actual, "z", "a"], names("transactions"))
    assert not result["is_valid"]
    assert result["missing_columns"] == ["Amount", "Zip"]
    assert result["unexpected_columns"] == ["a", "z"]
    assert (result["expected_count"], result["actual_count"]) == (15, 15)


def test_type_differences():
    assert contracts.check_types({"a": "int64"}, {"a": "int64"}) == {
        "is_valid": True, "mismatched_columns": {}}
    result = contracts.check_types({"a": "str"}, {"a": "int64", "b": "str"})
    assert result["mismatched_columns"] == {
        "a": {"expected": "int64", "actual": "str"},
        "b": {"expected": "str", "actual": None},
    }


@pytest.mark.parametrize("domain, columns, secret", [
    ("transactions", 15, []),
    ("cards", 13, ["Card Number", "CVV"]),
    ("users", 18, ["Person", "Address", "Apartment", "Latitude", "Longitude"]),
])
def test_registry(domain, columns, secret):
    contract = contracts.REGISTRY[domain]
    assert len(contract) == len(contracts.expected_types(contract)) == columns
    assert contracts.sensitive_columns(contract) == secret


def test_sensitive_columns_are_dropped_and_leaks_found(spark):
    users = spark.createDataFrame([], contracts.USERS)
    open_part = contracts.without_sensitive(users, contracts.USERS)
    assert "Person" not in open_part.columns and len(open_part.columns) == 13
    contracts.assert_not_exposed(open_part, "users")
    with pytest.raises(ValueError, match="Address.*Person"):
        contracts.assert_not_exposed(users, "users")


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"t is missing required columns: \['x', 'y'\]"):
        contracts.require_columns(spark.range(1), ["y", "x", "id"], "t")
