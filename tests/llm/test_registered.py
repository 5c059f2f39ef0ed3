"""The registered queries against their SQL on the smallest data."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
import check
from platewise.llm.queries import QUERIES
from platewise.llm.sql import oracle_queries

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = set(QUERIES) | {"pipeline"}
    assert names <= set(contract.queries()) and len(names) == 14
    assert set(oracle_queries()) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, check.connect(FOLDER), FOLDER, name).startswith("ok")


@pytest.mark.parametrize("names", ["op5_language op6_quality op8_bpe", "op12_pieces op13_dialogue_repair op11_filter_audit"])
def test_tasks_do_not_import_the_package(tmp_path, names):
    """What is broadcast to the workers works in a process of another folder, where they cannot import platewise."""
    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {os.path.dirname(contract.__file__)!r})\n"
        "import __spark_entry__ as contract\n"
        "from platewise.session import build_session\n"
        "spark = build_session('elsewhere', 'local[4]')\n"
        f"for name in {names.split()!r}:\n"
        f"    print(name, len(contract.queries()[name](spark, {FOLDER!r}).collect()) > 0)\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert [line for line in done.stdout.splitlines() if "True" in line] == [f"{n} True" for n in names.split()], done.stderr[-2000:]
