"""Every registered profiling query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from mudlark.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(float(r[i]), 5) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_same_rows(spark, sql, name):
    got = catalog.queries()[name](spark, SF)
    rows = got.collect()
    if name in catalog.oracle_sql():
        expected = sql.sql(catalog.oracle_sql()[name])
        assert sorted(got.columns) == sorted(expected.columns)
        assert rows_of(rows, got.columns) == rows_of(expected.fetchall(), expected.columns)


def test_whole_tables(spark):
    """No alignment and no annotation is left out before the operators."""
    samples = {}
    for r in catalog.view(spark, SF, "fx_align").collect():
        samples.setdefault(f"{r.sample_id}_{r.read_id}", []).append(r.flag)
    got = {r.sample_id: r.total for r in catalog.queries()["empty_samples_whole"](spark, SF).collect()}
    assert got == {s: len(flags) for s, flags in samples.items() if all(f & 4 for f in flags)}
    func, roles = {r.uniprot: r.func for r in catalog.view(spark, SF, "fx_trembl").collect()}, {}
    for r in catalog.view(spark, SF, "fx_linkout").collect():
        if r.uniprot_id in func:
            roles[r.patric_id] = max(roles.get(r.patric_id, ""), func[r.uniprot_id])
    assert {r.patric_id: r.role for r in catalog.queries()["merge_linkout_whole"](spark, SF).collect()} == roles


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
