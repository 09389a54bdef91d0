"""Every operator's query with SQL against it; queries without SQL are known as such."""

import pytest

import __spark_entry__ as registered
from oracle_check import difference, duck
from tidemark.llm import oracles, queries


def test_queries_are_registered():
    assert set(queries.ALL) <= set(registered.queries()) and "pipeline" in registered.queries()
    assert set(oracles.SQL) <= set(registered.oracle_sql())
    assert {n for n in queries.ALL if n not in oracles.SQL} == {
        "op1_token_counts", "op3_pii", "op4_quality", "op5_simhash", "op6_toxicity", "op7_decontamination", "op8_line_dedup",
        "op9_language_id", "op10_sentencepiece", "op12_mixing",
    }


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_agrees_with_sql(spark, sf, name):
    assert difference(queries.ALL[name](spark, sf), duck(sf), oracles.SQL[name]) is None
