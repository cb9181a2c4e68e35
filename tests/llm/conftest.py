import duckdb
import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""
    a = " ".join(f"word{i % 97}x{i}" for i in range(120))
    b = a.replace("word5x5", "changed")
    passage = "\n".join(f"shared line {k * k} of the passage, {'long ' * (k % 3)}and so on" for k in range(12))
    rows = [
        (1, a, "en", "s1", len(a)), (2, a, "en", "s1", len(a)), (3, b, "en", "s2", len(b)), (4, None, "en", "s1", 0), (5, "", "de", None, 0),
        (6, f"Intro one\nintro two\n{passage}\nend one", "en", "s2", 9), (7, f"Other\nhead\nlines\n{passage}\nother end\nof it", "en", "s3", 9),
        (None, "no id at all", "fr", "s1", 12), (8, "a b a b a b a b " * 20, "en", "s3", 320), (8, "a b a b a b a b " * 20, "en", "s3", 320),
        (9, "x" * 70_000 + " tail \n\t y" * 9_000, "en", "s2", 9), (10, "one", "en", "é", 3), (11, "Two words", "es", "s2", 9), (12, "two WORDS", "es", "s2", 9),
        (13, "  lead  and trail  ", "en", "s1", 19), (14, "# $ symbols <tag> | &\nsame line\nsame line\n\n \n", "en", "s1", 40),
        (15, "日本 語 ▁ mark 'quoted' <|endoftext|> \U0001f600", "ja", "s4", 30),
    ]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, kinds)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"own {c}") for c in ("host", "id", "size", "rep", "n", "component", "lines", "copies")})


@pytest.fixture()
def in_duckdb(tmp_path):
    """Rows of a query text over a DataFrame registered as documents."""

    def run(df, sql, name="documents"):
        path = f"{tmp_path}/{name}.parquet"
        df.write.mode("overwrite").parquet(path)
        con = duckdb.connect()
        con.execute(f"create view {name} as select * from '{path}/*.parquet'")
        rel = con.execute(sql)
        columns = [c[0] for c in rel.description]
        return [dict(zip(columns, r, strict=True)) for r in rel.fetchall()]

    return run


@pytest.fixture()
def same_rows():
    def check(df, expected):
        got = [r.asDict() for r in df.collect()]
        key = lambda r: str(sorted((k, round(v, 9) if isinstance(v, float) else v) for k, v in r.items()))
        assert sorted(map(key, got)) == sorted(map(key, expected))

    return check
