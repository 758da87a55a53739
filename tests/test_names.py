from hypothesis import given
from hypothesis import strategies as st
import pytest

from smeltery.functions import names
from smeltery.vocabulary import Vocabulary


@pytest.mark.parametrize(
    ("heading", "expected"),
    [
        (" Station Name ", "station_name"),
        ("Entries & Exits", "entries_and_exits"),
        ("A--B__C", "a_b_c"),
        ("2024/25 (est.)", "2024_25_est"),
        ("???", "unnamed_column"),
        ("", "unnamed_column"),
        ("Café", "caf"),
    ],
)
def test_canonical_name(heading, expected):
    assert names.canonical_name(heading) == expected


def test_repeated_names_take_the_next_free_number():
    assert names.unique_names(["a", "A!", "a"]) == ["a", "a_2", "a_3"]
    assert names.unique_names(["a", "a!", "a_2"]) == ["a", "a_2", "a_2_2"]
    assert names.unique_names(["a_2", "a", "a", "a"]) == ["a_2", "a", "a_3", "a_4"]


@given(st.lists(st.text(alphabet="aA_2! &", max_size=5), max_size=20))
def test_names_are_unique_and_stable(headings):
    found = names.unique_names(headings)
    assert len(found) == len(set(found)) == len(headings)
    assert names.unique_names(headings) == found


def test_numeric_hint_goes_by_token_and_code_rules_it_out():
    assert names.numeric_hint("total_entries")
    assert names.numeric_hint("Usage-2024")
    assert not names.numeric_hint("entries_code")
    assert not names.numeric_hint("totals")  # token must match as a whole


def test_metric_hint_goes_by_substring():
    assert names.metric_hint("subtotals")
    assert not names.metric_hint("name")


def test_exclusions():
    for name in ("_usage", "station_key", "entries_rank", "usage_code", "latitude",
                 "financial_year_start", "frankfurt_usage"):
        assert names.excluded_hint(name)
    assert not names.excluded_hint("entries")
    assert names.excluded_hint("shop_key", Vocabulary(entity="shop"))


def test_identity_columns_are_the_first_four_in_order():
    columns = ["x", "NLC", "_station_name", "station_code", "Station_Name", "crs", "station"]
    assert names.identity_columns(columns) == ["NLC", "station_code", "Station_Name", "crs"]


def test_primary_metric():
    assert names.primary_metric(["interchanges", "exits", "entries_2024"]) == "entries_2024"
    assert names.primary_metric(["b", "a"]) == "b"
    with pytest.raises(ValueError):
        names.primary_metric([])
