"""Every query with SQL gives the rows that an independent engine gives on the smallest tables; the entry point holds without the optional subpackage."""

from __future__ import annotations

import glob
import math
import os
import re
import subprocess
import sys

import duckdb
import pytest

from weftline.plans.oracle import ORACLE
from weftline.plans.queries import FLAGSHIP, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def engine(data):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in glob.glob(f"{data}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return connection


def rows(frame, columns):
    def plain(value):
        if value is None or value != value:
            return "null"
        if isinstance(value, float):
            return str(int(value)) if value == math.floor(value) else f"{value:.6f}"
        return str(value)

    return sorted(tuple(plain(v) for v in r) for r in frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, data, engine, name):
    made, wanted = QUERIES[name](spark, data).toPandas(), engine.execute(ORACLE[name]).df()
    assert sorted(made.columns) == sorted(wanted.columns)
    assert rows(made, sorted(made.columns)) == rows(wanted, sorted(made.columns))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_values(spark, data, name):
    """All columns are worked out, none is null throughout, and what a row says doesn't change from run to run."""
    made = QUERIES[name](spark, data)
    found = made.collect()
    assert found and all(any(r[c] is not None for r in found) for c in made.columns)
    assert sorted(map(str, found)) == sorted(map(str, QUERIES[name](spark, data).collect()))


def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()


def test_masking_against_another_engine(spark, data):
    from weftline.operators import formatting

    wanted = {r.doc_id: r.text and re.sub(formatting.PUBLIC_IP, formatting.IP_MASK, re.sub(formatting.EMAIL, formatting.EMAIL_MASK, r.text, flags=re.ASCII), flags=re.ASCII) for r in documents(spark, data)}
    assert {r.doc_id: r.text for r in QUERIES["pii_masking"](spark, data).collect()} == wanted


def test_repetition_against_counting(spark, data):
    got = {r.doc_id: r for r in QUERIES["repetition_shares"](spark, data).collect()}
    for r in documents(spark, data):
        words, size = (r.text or "").split(), max(1, len(r.text or ""))
        grams = [" ".join(words[i : i + 2]) for i in range(len(words) - 1)]
        most = max(map(grams.count, set(grams)), default=0)
        assert math.isclose(got[r.doc_id].top_2, most * max(len(g) for g in set(grams) if grams.count(g) == most) / size if most > 1 else 0.0)
        seen, repeated, i = [], 0, 0
        while i + 5 <= len(words):
            five = words[i : i + 5]
            if five in seen:
                repeated, i = repeated + len("".join(five)), i + 5
            else:
                seen.append(five)
                i += 1
        assert math.isclose(got[r.doc_id].duplicate_5, repeated / size)


def test_near_classes_against_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in documents(spark, data)]
    sets = {}
    for i, text in rows:
        words = (text or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sure = []
    for a, ta in rows:
        for b, tb in rows:
            if a < b and ta is not None and (ta == tb or sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                sure.append((a, b))
    got = {r.doc_id: r.component for r in QUERIES["near_dedup"](spark, data).collect()}
    assert len(got) == len(rows) and sum(got[a] == got[b] for a, b in sure) >= 0.9 * len(sure)
    for a, b in sure:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    # What shares a class is alike: no class joins texts of which no two share half their shingles.
    for a, ta in rows:
        c = got[a]
        if c != a:
            assert any(ta == tb or len(sets[a] & sets[b]) >= 0.3 * len(sets[a] | sets[b]) for b, tb in rows if b != a and got[b] == c)


def test_strata_have_their_shares(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()
    test = QUERIES["stratified_split"](spark, data).collect()
    counts = {}
    for r in rows:
        counts[r.lang] = counts.get(r.lang, 0) + 1
    found = {}
    for r in test:
        found[r.lang] = found.get(r.lang, 0) + 1
    assert found == {k: n // 10 for k, n in counts.items() if n // 10} and len({r.doc_id for r in test}) == len(test)


def test_packing_holds_every_row_once(spark, data):
    from weftline.operators import packing

    lengths = [len((r.text or "").split()) for r in documents(spark, data)]
    made = QUERIES["pack_best_fit"](spark, data).collect()
    fitting = [n for n in lengths if 0 < n <= 1024]
    assert len(made) == len(packing.best_fit(lengths, 1024)) and len(made) >= -(-sum(fitting) // 1024)


def test_texts_stay_out_of_shuffles(spark, data):
    """Keys and hashes alone are shuffled where a text is wanted for its hash alone."""
    for name in ("exact_dedup", "decontam_exact", "array_split_chunks", "validation_split"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Aggregate" in line or "Join" in line:
                assert "text#" not in line.split("Statistics")[0].replace("md5", ""), (name, line)


def test_flagship(spark, data):
    assert FLAGSHIP(spark, data).count() > 0


def test_entry_point_without_the_optional_subpackage(tmp_path):
    code = "import sys; sys.modules['weftline.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('p1_') for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert said == [str(len(QUERIES)), "False"]


def test_nothing_else_imports_the_optional_subpackage():
    for file in glob.glob(f"{ROOT}/weftline/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in file:
            with open(file, encoding="utf-8") as f:
                assert not re.search(r"(?:import|from)\b[^\n]*\bllm\b", f.read()), file
