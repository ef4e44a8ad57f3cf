import duckdb
import pytest

from revue.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
#: Names that operators use inside, as extra columns of their input.
CLASHES = ["id", "t", "keep_id", "class_id", "kept", "size", "src", "_key", "shard", "slot", "row", "copy", "m",
           "lang_pred", "score", "rejected", "n_tokens", "q_url", "dropped_id"]
LONG = "lorem ipsum dolor sit amet consetetur " * 4000


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [(1, "a b c", "en", "s1"), (2, "a  b\tc", "en", "s1"), (3, "abc", None, "s2"), (4, None, "en", None),
            (5, "", None, "s1"), (6, " \n", "fr", "s2"), (None, "no id here at all", "en", "s1"), (7, LONG, "en", "s2"),
            (7, LONG, "en", "s2"), (8, "!!! 123", "en", None), (9, "é à ü", "fr", "s1"), (9, "é à ü", "fr", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for k, name in enumerate(CLASHES):
        df = df.selectExpr("*", f"{k} as `{name}`")
    return df


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: [(x is None, x) for x in r])


def oracle(name, sf=SMALL):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    rel = con.sql(ORACLE[name])
    return rel.columns, rel.fetchall()


__all__ = ["CLASHES", "LONG", "ORACLE", "QUERIES", "SMALL", "oracle", "rows_of"]
