"""Registered corpus queries against their SQL."""

import pytest

from checks.compare import compare, connect
from ordertide.llm.oracle import ORACLE
from ordertide.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, name):
    state, detail = compare(spark, connect(sf), sf, QUERIES[name], ORACLE[name])
    assert state == "ok", detail


def test_copies_share_a_class(spark, sf):
    found = QUERIES["op7_minhash_near_dedup"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    both = docs.merge(found, on="doc_id")
    assert len(both) == len(docs) == len(found)
    assert (both.groupby("text").class_id.nunique() == 1).all()
