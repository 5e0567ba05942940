"""The queries of this subpackage run over the smallest tables and have the columns asked for."""

from __future__ import annotations

import pytest

from weftline.llm import packing, textstats
from weftline.llm.oracle import ORACLE
from weftline.llm.queries import QUERIES

COLUMNS = {
    "p1_found": ["id", "kind"], "p2_found": ["conv_id", "turn", "defect"], "p4_found": ["id", "item_id"], "p5_found": ["conv_id", "turn"], "p6_found": ["id", "language"],
    "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    made = QUERIES[name](spark, data)
    if name in COLUMNS:
        assert made.columns == COLUMNS[name]
    rows = made.collect()
    assert rows
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows)


def test_every_document_is_encoded_and_packed(spark, data):
    n = spark.read.parquet(f"{data}/documents.parquet").count()
    assert QUERIES["p7_ids"](spark, data).count() == n
    assert QUERIES["p8_containers"](spark, data).select("doc_id").distinct().count() == n


def rows_of(spark, data, name):
    return QUERIES[name](spark, data).collect()


def test_findings_follow_from_what_is_measured(spark, data):
    """What each query finds is what the rows of its measures say, and totals are sums of their rows."""
    scored = rows_of(spark, data, "p1_statistics")
    assert {(r.id, r.kind) for r in scored if r.score >= textstats.CUT} == {tuple(r) for r in rows_of(spark, data, "p1_found")}
    assert all((r.kind is None) == (r.score < textstats.CUT) and 0 <= r.common_words <= 1 and r.words >= 0 for r in scored)
    assert {r.doc_id for r in rows_of(spark, data, "p9_curves") if r.score >= 1 and r.words} == {r.doc_id for r in rows_of(spark, data, "p9_found")}
    first = {(r.conv_id, r.turn): r.defect for r in rows_of(spark, data, "p2_found")}
    defects = {(r.conv_id, r.turn, r.defect) for r in rows_of(spark, data, "p2_defects")}
    assert {d[:2] for d in defects} == set(first) and {(*k, d) for k, d in first.items()} <= defects
    scores = rows_of(spark, data, "p5_scores")
    offending = {(r.conv_id, r.turn) for r in scores if r.score >= 1}
    assert offending == {tuple(r) for r in rows_of(spark, data, "p5_found")}
    rates = rows_of(spark, data, "p5_rates")
    assert sum(r.messages for r in rates) == len(scores) and sum(r.offending for r in rates) == len(offending) and all(abs(r.rate - r.offending / r.messages) < 1e-9 for r in rates)
    tokens, slices = rows_of(spark, data, "p3_tokens"), rows_of(spark, data, "p3_slices")
    for name in ("source", "language", "domain", "all"):
        own = [r for r in slices if r.slice == name]
        assert sum(r.documents for r in own) == len(tokens) and sum(r.tokens for r in own) == sum(r.tokens for r in tokens)


def test_documents_languages_have_one_row_each(spark, data):
    ids = {r.id for r in spark.read.parquet(f"{data}/dataset.parquet").select("id").collect()}
    made = rows_of(spark, data, "p6_languages")
    assert len(made) == len(ids) and {r.id for r in made} == ids and all(0 <= r.confidence <= 1 for r in made)


def test_containers_hold_what_they_can(spark, data):
    used: dict[int, int] = {}
    for r in rows_of(spark, data, "p8_containers"):
        if r.container:
            used[r.container] = used.get(r.container, 0) + r["size"]
    assert max(used.values()) <= packing.CAPACITY and len(used) <= -(-sum(used.values()) // packing.CAPACITY) + 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, data, name):
    import glob
    import math
    import os

    import duckdb

    engine = duckdb.connect()
    for file in glob.glob(f"{data}/*.parquet"):
        engine.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    made, wanted = QUERIES[name](spark, data).toPandas(), engine.execute(ORACLE[name]).df()
    columns = sorted(made.columns)
    assert columns == sorted(wanted.columns)

    def plain(frame):
        return sorted(tuple("-" if v is None or v != v else round(v, 5) + 0.0 if isinstance(v, float) else str(v) for v in r) for r in frame[columns].itertuples(index=False))

    got, want = plain(made), plain(wanted)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(math.isclose(x, y, abs_tol=1e-5) if isinstance(x, float) and isinstance(y, float) else x == y for x, y in zip(a, b)), (a, b)
