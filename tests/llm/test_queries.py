"""The registered queries: oracle SQL where there is one, and the contracts' columns."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

COLUMNS = {
    "op1_": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
             "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op4_": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
             "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op5_": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean",
             "text_sha256": "string"},
    "op6_": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
             "sequence_id": "bigint", "offset": "bigint"},
    "op7_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
             "base_sha256": "string", "spans": "string"},
    "op9_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op10_": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op11_": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
              "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "op13_": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
              "slot": "bigint", "grown_shard": "int"},
}


def name_of(prefix):
    found = [n for n in queries() if n.startswith(prefix)]
    assert len(found) == 1
    return found[0]


@pytest.mark.parametrize("prefix", [p for p in COLUMNS if p not in ("op8_", "op3_")])
def test_columns_and_oracle(spark, prefix):
    name = name_of(prefix)
    df = queries()[name](spark, SF_SMALL)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS[prefix]} == COLUMNS[prefix]
    got = df.toPandas()
    documents = duckdb.sql(f"SELECT doc_id FROM '{SF_SMALL}/documents.parquet'").fetchdf()
    assert set(got.doc_id) == set(documents.doc_id)
    if prefix != "op6_":
        assert len(got) == len(documents)
    if name in oracle_sql():
        approx, exact, msg = compare(got, duck(SF_SMALL).execute(oracle_sql()[name]).fetchdf())
        assert approx and exact, msg


def test_language_model_beats_its_base_on_held_out_texts(spark):
    df = queries()[name_of("op3_")](spark, SF_SMALL)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS["op3_"]} == COLUMNS["op3_"]
    held = [r for r in df.collect() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] <= 0 and r["n_known"] <= r["n_tokens"] for r in held)


def test_ranked_search(spark):
    name = name_of("op12_")
    df = queries()[name](spark, SF_SMALL)
    assert dict(df.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    approx, exact, msg = compare(df.toPandas(), duck(SF_SMALL).execute(oracle_sql()[name]).fetchdf())
    assert approx and exact, msg
