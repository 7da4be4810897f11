"""The registered queries: each against its SQL, and the same whatever the number of shuffle partitions."""

import os

import duckdb
import pytest

from shardwright.plans import catalogue, stored  # noqa: F401 (stored registers its queries)

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


def cells(rows, columns):
    show = lambda v: "NULL" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[c]) for c in columns) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_queries_give_what_their_sql_gives(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = duck.sql(catalogue.ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    theirs = [dict(zip(want.columns, r, strict=True)) for r in want.fetchall()]
    assert cells(got.collect(), columns) == cells(theirs, columns)


@pytest.mark.parametrize("name", ["mixture_capped", "duplicate_digest", "token_longest_run", "sample_offsets", "text_row_violations", "token_sample"])
def test_results_do_not_depend_on_partitions(spark, name):
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "8", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = catalogue.QUERIES[name](spark, SF)
            seen.append(cells(df.collect(), sorted(df.columns)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
