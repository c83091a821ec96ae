import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "labels", "pages"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
EXTRA = ", host string, node long, key string, label string, tokens string, h long, held boolean, grp int, n_words long"


def doc_rows(pairs):
    return [(i, t, "en", "src1", len(t or "")) for i, t in pairs]


def odd_pairs():
    """Nulls, empties, blanks, one word, copies, repeated rows, a null id, a long text."""
    base = "the quick brown fox jumps over the lazy dog while seventeen other foxes look on and wonder"
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, base), (5, base), (6, base), (7, "One"), (None, base + " now"), (8, long), (9, long + " end")]


@pytest.fixture()
def odd_docs(spark):
    rows = [r + ("x", 1, "k", "l", "t", 2, True, 3, 4) for r in doc_rows(odd_pairs())]
    return spark.createDataFrame(rows, DOCS + EXTRA)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def docs_of(spark):
    return lambda pairs: spark.createDataFrame(doc_rows(pairs), DOCS)


@pytest.fixture()
def same_as_sql(spark):
    def check(name, sf=SF):
        from tidemark.llm import queries

        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        got = queries.QUERIES[name](spark, sf)
        want = con.execute(queries.ORACLE[name])
        cols = [c[0] for c in want.description]
        assert sorted(cols) == sorted(got.columns)
        a = sorted(map(repr, map(tuple, got.select(*cols).collect())))
        assert a == sorted(map(repr, want.fetchall())) and a

    return check
