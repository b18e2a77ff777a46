"""Fixtures shared by the tests of the training-data operators."""
import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from salescope.sources.tables import TABLE_NAMES  # noqa: E402

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of names that operators use for their own results.
CLASHES = "size long, language string, removed_lines string, copies string, row string, fp string, spans int, found int"


def docs_of(spark, rows, clashes=False):
    """Documents from (doc_id, text, lang, source) rows."""
    full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
    if not clashes:
        return spark.createDataFrame(full, DOCS)
    return spark.createDataFrame([(*r, 1, "x", "y", "z", "r", "f", 2, 3) for r in full], f"{DOCS}, {CLASHES}")


def odd_documents(long_text: str):
    """Nulls in every column, empty and long texts, repeated rows, ties."""
    return [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
        (2, None, "en", "a"), (3, "", None, "b"), (4, " \t\n\n ", "fr", None),
        (None, "le renard brun saute par dessus le chien", "fr", None), (None, None, None, None),
        (5, long_text, "en", "a"), (6, long_text, "en", "c"), (7, "12345 !!! ???", "en", "c"),
    ]


LONG = "\n".join(" ".join(f"w{(i * 7 + j) % 997}" for j in range(12)) + f" line{i}" for i in range(2500))


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v


def rows_of(df):
    cols = sorted(df.columns)
    recs = df[cols].astype(object).where(df[cols].notna(), None)
    return cols, sorted((tuple(norm(v) for v in r) for r in recs.itertuples(index=False)),
                        key=lambda r: tuple((x is None, str(x)) for x in r))


def same_as_sql(spark, name, sf_dir):
    import __spark_entry__ as E
    sc, sr = rows_of(E.queries()[name](spark, sf_dir).toPandas())
    dc, dr = rows_of(duck(sf_dir).execute(E.oracle_sql()[name]).df())
    assert sc == dc
    assert len(sr) == len(dr)
    for a, b in zip(sr, dr):
        for x, y in zip(a, b):
            assert x == y or isinstance(x, (int, float)) and isinstance(y, (int, float)) and math.isclose(
                x, y, rel_tol=1e-6, abs_tol=1e-6), (a, b)


def components(n, links):
    """Smallest member of each of n nodes' component."""
    low = list(range(n))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        low[b] = a
    return [root(x) for x in range(n)]
