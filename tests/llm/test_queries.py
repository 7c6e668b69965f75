"""The registered queries: contracts of their columns, and the SQL oracle."""

import pytest

import __spark_entry__ as E
from censuskit.llm.queries import ORACLE, QUERIES
from scripts.check_oracle import compare, duck
from tests.conftest import SF001, SF01

COLUMNS = {
    "op1_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op2_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op4_suffixes": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op5_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op6_paragraphs": "doc_id bigint, n_removed int, n_spans int, removed array<struct<start:int,words:int>>",
    "op7_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op8_lines": "page_id bigint, host string, n_lines int, n_dropped int, kept_sha256 string",
    "op9_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_decontamination": "doc_id bigint, item_id bigint, start_word int, n_words int, hamming int, similarity double",
    "op11_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint, first_position double",
    "op12_conversations": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op13_interactions": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
}
TABLE = {"op7_warc": ("pages", "page_id"), "op8_lines": ("pages", "page_id"), **{n: ("documents", "doc_id") for n in COLUMNS if n.split("_")[0][2:] in ("2", "3", "4", "5", "6", "9", "11")}}


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract(spark, name):
    df = QUERIES[name](spark, SF001)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == COLUMNS[name]
    rows = df.collect()
    if name in TABLE:  # a row for each row of the whole table
        table, key = TABLE[name]
        assert sorted(r[key] for r in rows) == sorted(r[0] for r in spark.read.parquet(f"{SF001}/{table}.parquet").select(key).collect())
    else:
        assert rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    problems, _, n = compare(spark, duck(SF01), name, QUERIES[name], ORACLE[name], SF01)
    assert not problems and n > 0
