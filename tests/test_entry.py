import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import catalog

from .conftest import SMALL


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_against_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SMALL).toPandas()
    cols = sorted(got.columns)
    if name in catalog.oracle_sql():
        want = duck.sql(catalog.oracle_sql()[name]).df()
        assert cols == sorted(want.columns)
        show = lambda d: d[cols].astype(str).sort_values(cols).reset_index(drop=True)
        assert show(got).equals(show(want))
    else:
        assert len(got) > 0


def test_blocked_text_is_looked_for_in_whole_pages(spark, tmp_path):
    body = "<p>" + "plain words " * 60
    rows = [(1, "https://a.org/x", f"<html>{body}</p><div>We use Cookies</div></html>"), (2, "https://a.org/y", f"<html>{body}</html>"), (3, "https://a.org/z", "<script>var cookies = 1</script>" + body), (4, "https://a.org/w", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    assert {r.seq for r in catalog.queries()["blocked_text_filter"](spark, f"file://{tmp_path}").collect()} == {2, 3, 4}
