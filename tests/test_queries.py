"""Every registered query: the contract, and the same rows as its SQL."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
import check
from platewise.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.connect(FOLDER)


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["item_id", "users", "number", "menu_name"]
    assert [(r["item_id"], r["users"]) for r in found.orderBy("number").collect()] == [
        ("4", 54), ("23", 50), ("46", 49), ("25", 46), ("69", 45)]


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) - set(contract.oracle_sql()) == {"knn_ivf", "knn_lsh"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert check.compare(spark, db, FOLDER, name).startswith(("ok", "rows"))


def test_repository_is_importable_from_elsewhere():
    assert os.path.exists(os.path.join(os.path.dirname(contract.__file__), "platewise", "__init__.py"))


def test_tasks_do_not_import_the_package(tmp_path):
    """Python tasks work where the workers cannot import platewise: in a process of another folder."""
    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {os.path.dirname(contract.__file__)!r})\n"
        "import __spark_entry__ as contract\n"
        "from platewise.session import build_session\n"
        "spark = build_session('elsewhere', 'local[2]')\n"
        f"print('rows', contract.queries()['knn_lsh'](spark, {FOLDER!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 50" in done.stdout, done.stderr[-2000:]
