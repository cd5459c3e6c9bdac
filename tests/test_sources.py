"""A13 sheet reading: trimmed headers, rename map, quoted multi-line cells, blank rows dropped."""

import os
import tempfile

import pytest

from daybook.plans import assemble
from daybook.sources.tables import TABLES, check_sources, load_optional, read_sheet


def test_read_sheet(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-sheet-"), "t.csv")
    with open(path, "w") as f:
        f.write(' Area Of Focus ,Expected Message \n')
        f.write('Sleep,"line one\nline two, with comma"\n')
        f.write(',\n')
        f.write('Weight,"say ""hi"""\n')
    df = read_sheet(spark, path, rename={"Area Of Focus": "focus", "Expected Message": "message"})
    assert df.columns == ["focus", "message"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("Sleep", "line one\nline two, with comma"), ("Weight", 'say "hi"')]


@pytest.fixture(scope="module")
def without_customer(tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        if name not in ("customer", "pages"):
            os.symlink(f"/root/testdata/sf0.001/{name}.parquet", base / f"{name}.parquet")
    return str(base)


def test_all_absent_tables_are_named(spark, without_customer):
    with pytest.raises(ValueError, match="2 source.*customer.*pages"):
        check_sources(spark, without_customer, TABLES)
    check_sources(spark, without_customer, ["events", "orders"])


def test_wide_table_without_goals(spark, without_customer):
    """An optional role without its table: same columns and types, no goals."""
    lacking = assemble.daily_wide(spark, without_customer)
    whole = assemble.daily_wide(spark, "/root/testdata/sf0.001")
    assert [(f.name, f.dataType) for f in lacking.schema.fields] == [(f.name, f.dataType) for f in whole.schema.fields]
    r = lacking.selectExpr("count(*) n", "count(target_weight) t", "count(protein_goal) g", "max(total_nutrient_targets) m",
                           "count_if(within_maintenance) w").first()
    assert r.n == whole.count() and tuple(r)[1:] == (0, 0, 0, 0)
    empty = load_optional(spark, without_customer, "customer", "c_custkey bigint, c_acctbal double")
    assert empty.count() == 0 and empty.schema.simpleString() == "struct<c_custkey:bigint,c_acctbal:double>"
