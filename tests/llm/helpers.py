"""Fixtures shared by the tests of this folder."""

from __future__ import annotations

import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.01"

#: Columns whose names the operators use inside.
CLASH = ["id", "fp", "key", "line", "line_id", "h", "w", "words", "at", "u", "v", "n", "kept", "kept_lines", "component_id", "score", "items", "_doc", "_kept", "_rep", "_text", "lines", "item_no"]


def docs_df(spark, rows, clash: bool = True):
    """documents-like rows (doc_id, text) with columns of clashing names."""
    df = spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASH]) if clash else df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sf_table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


class Union:
    def __init__(self, n):
        self.p = list(range(n))

    def find(self, x):
        while self.p[x] != x:
            self.p[x] = self.p[self.p[x]]
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.p[b] = a
