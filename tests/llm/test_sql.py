"""The queries that SQL expresses against their SQL; the guard of the driver's entry."""

import subprocess
import sys

import pytest

from claimgrid.llm import queries
from tests.oracle import compare, connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    compare(connection(sf_dir), queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name])


def test_entry_lists_all():
    import __spark_entry__ as entry

    known = entry.queries()
    assert [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in known) == 1] == list(range(1, 14)) and "pipeline" in known
    assert set(entry.oracle_sql()) <= set(known)


def test_nothing_else_imports_the_subpackage():
    code = "import sys; import claimgrid.cli, claimgrid.plans.build, claimgrid.plans.driver, claimgrid.sources.processors; assert not any(m.startswith('claimgrid.llm') for m in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True).returncode == 0
