"""Registered queries against their SQL, and the columns the others return."""

import pytest

from pulsegrid.llm.oracles import ORACLES
from pulsegrid.llm.queries import llm_queries
from tools.check import compare, connect

COLUMNS = {
    "op1": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op2": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op4": "doc_id bigint, fingerprint string, component_id bigint, row_key bigint",
    "op5": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op6": "page_id bigint, url string, text string, n_chars bigint",
    "op7": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8": "query_id bigint, rank int, vec_id bigint, score double",
    "op9": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op10": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op11": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op12": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op13": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
}


def test_names():
    names = [n for n in llm_queries() if n != "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted(COLUMNS) and set(ORACLES) < set(names)


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns(spark, small, number):
    (query,) = (q for n, q in llm_queries().items() if n.split("_")[0] == number)
    assert ", ".join(f"{n} {t}" for n, t in query(spark, small).dtypes) == COLUMNS[number]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    df = llm_queries()[name](spark, small)
    cursor = connect(small).execute(ORACLES[name])
    assert compare(df.columns, df.collect(), [d[0] for d in cursor.description], cursor.fetchall()) == ""
