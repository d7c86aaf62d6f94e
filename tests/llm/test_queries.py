"""The registered queries of the corpus operators."""

import inspect

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from lodestar.llm import queries

CONTRACT = {
    "op3_token_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op7_minhash_neardup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op8_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_align": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_simhash": ["doc_id", "fingerprint", "component_id"],
}


def test_one_query_an_operator():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    got = entry.queries()[name](spark, SF_SMALL)
    assert got.columns[:len(CONTRACT[name])] == CONTRACT[name]
    kinds = dict(got.dtypes)
    for c in CONTRACT[name]:
        want = {"held_out": "boolean", "kept": "boolean", "score": "double"}.get(
            c, "string" if c in ("spans", "lang_pred", "fingerprint") or c.endswith("sha256") else "bigint")
        assert kinds[c] == want, c
    assert got.count() == 200


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = entry.queries()[name](spark, SF_SMALL)
    rel = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(rel.fetchall())


def test_no_local_checkpoint_and_no_row_limits():
    for module in ("op1_toxicity", "op2_license", "op3_token_ids", "op4_pii", "op5_decontaminate", "op6_exact", "op7_neardup",
                   "op8_substring", "op9_sentencepiece", "op10_language", "op11_align", "op12_collocations", "op13_simhash"):
        source = inspect.getsource(__import__(f"lodestar.llm.{module}", fromlist=["x"]))
        assert "localCheckpoint" not in source and ".limit(" not in source and "crossJoin" not in source
