"""Document queries against their SQL twins on texts the driver tables do not hold: empty, blank and NULL ones."""

import os

import duckdb
import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
TEXTS = ["''", "' '", "' two  words '", "NULL", "'a\"b\\c'||chr(10)||chr(9)", "'null'", "'e'||repeat(chr(769),300)", "repeat(chr(128512),300)"]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    for f in os.listdir(SMALL):
        if f != "documents.parquet":
            os.symlink(f"{SMALL}/{f}", folder / f)
    rows = " UNION ALL ".join(f"SELECT {1000 + i}::BIGINT, {text}, 'en', 'odd', 7::BIGINT" for i, text in enumerate(TEXTS))
    docs = f"SELECT doc_id, text, lang, source, n_chars FROM '{SMALL}/documents.parquet' WHERE doc_id < 20 UNION ALL {rows}"
    duckdb.sql(f"COPY ({docs}) TO '{folder}/documents.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["localized_titles", "movie_details", "simple_details", "title_credits", "snapshot_newest_payload", "localized_of_every_kind"])
def test_odd_texts(spark, odd, name):
    _, rows, diff = compare(spark, connect(odd), name, entry.queries()[name], entry.oracle_sql()[name], odd)
    assert rows and diff is None, diff
