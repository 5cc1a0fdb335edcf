"""The entry points with and without the corpus operators."""

import importlib
import sys

import pytest

import __spark_entry__ as entry
from gaugeline.plans.oracles import ORACLES
from gaugeline.plans.queries import QUERIES

OPTIONAL = ("gaugeline.llm", "corpus_pipeline")


@pytest.fixture
def without(monkeypatch):
    def hide(*names):
        for name in list(sys.modules):
            if name.startswith(OPTIONAL):
                monkeypatch.delitem(sys.modules, name)
        for name in names:
            monkeypatch.setitem(sys.modules, name, None)

    return hide


def there():
    return all(importlib.util.find_spec(name) is not None for name in OPTIONAL)


@pytest.mark.parametrize("hidden", [OPTIONAL, OPTIONAL[:1], OPTIONAL[1:]])
def test_the_rest_works_without_them(without, hidden):
    without(*hidden)
    assert entry.queries() == QUERIES
    assert entry.oracle_sql() == ORACLES


def test_other_import_errors_are_not_hidden(without, monkeypatch):
    if not there():
        pytest.skip("the corpus operators are not there")
    without()
    monkeypatch.setitem(sys.modules, "pyarrow", None)
    with pytest.raises(ModuleNotFoundError):
        entry.queries()


def test_every_operator_is_registered():
    if not there():
        pytest.skip("the corpus operators are not there")
    names = entry.queries()
    numbers = {name.split("_")[0] for name in names if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) < set(names)
