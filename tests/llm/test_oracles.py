"""The text queries that SQL can express against DuckDB."""

import pytest

import oracle
from eventlayers.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    n, extra, missing = oracle.compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert (extra, missing) == ([], []) and n > 0


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_quality_sql_on_rows_without_or_with_other_labels(spark, con):
    """The stop-word bound of the SQL is that of the rule where the label is missing or names another language."""
    import duckdb

    words = " ".join(f"mot{i} haus" for i in range(60))
    rows = [(k, words + extra, lang) for k, (lang, extra) in enumerate(
        [(None, ""), ("ru", ""), ("en", ""), ("EN", ""), ("", ""), ("de", " und die das der"), (None, " # # #"), ("xx", " $" * 90)]
    )]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    own = duckdb.connect()
    own.register("documents", docs.toPandas())
    from eventlayers.llm import quality

    n, extra, missing = oracle.compare(quality.quality_rules(docs), own, ORACLES["op8_quality_rules"])
    assert (n, extra, missing) == (len(rows), [], [])
