"""Shared helpers of the tests: rows of awkward documents, and running queries against DuckDB."""

from __future__ import annotations

import duckdb

SMOKE = "/root/testdata/sf0.001"
EDGES = [None, "", " ", "\n\t", "Is", "Hello World", "hello world", "hello  world", "Éa été", "éa été", "日本語テキスト", "a" * 5000,
         "x " * 3000, "12 34 !!", "<|endoftext|>", "nul\x00byte", "one two three four five six seven"]


def edge_docs(spark, extra=()):
    """Documents with nulls in any column, empty and long texts, ties, repeats and clashing extra columns."""
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "s0"][i % 2], len(t or ""), i, "x") for i, t in enumerate([*EDGES, *EDGES[:8], *extra])]
    rows += [rows[5], rows[5], (None, "hello world", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size long, digest string")


def duck_rows(sql: str, sf_dir: str, columns: list[str]) -> list[tuple]:
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    result = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})")
    return sorted(result.fetchall(), key=repr)


def rows_of(df, columns: list[str]) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
