"""Registered queries, their SQL, and the pipeline against brute force."""

import hashlib

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as E
import corpus_pipeline
from loanscore.llm import byte_bpe, queries
from loanscore.llm.common import table
from tests.conftest import SMOKE
from tests.llm.cases import documents
from tests.llm.test_order_minhash import brute_classes
from tests.llm.test_text_operators import RANKS, brute_counts, brute_hits
from tests.oracle_check import rows_of_duck, rows_of_spark, type_issues


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMOKE}/{name}.parquet'")
    return c


def test_all_queries_are_registered():
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    frame = queries.registry()[name](spark, SMOKE)
    spark_names, spark_rows = rows_of_spark(frame)
    duck_names, duck_rows, rel = rows_of_duck(con, queries.oracle_sql()[name])
    assert spark_names == duck_names
    assert not type_issues(frame, rel)
    assert spark_rows == duck_rows


def brute_pipeline(rows, items):
    """(doc_id, text) that pass the first three stages; hosts are judged as one list each."""
    counts = {n: brute_counts(t) for n, (_, t, _) in enumerate(rows)}
    failed = {n: c[0] < 10 or 100 * c[4] > 20 * c[0] for n, c in counts.items()}
    hosts = {}
    for n, (_, _, host) in enumerate(rows):
        hosts.setdefault(host, []).append(failed[n])
    rates = [sum(f) / len(f) for f in hosts.values()]
    mean = sum(rates) / len(rates)
    var = sum((r - mean) ** 2 for r in rates) / len(rates)
    strength = mean * (1 - mean) / var - 1 if 0 < var < mean * (1 - mean) else None
    bad = {h for h, f in hosts.items() if (mean if strength is None else (sum(f) + mean * strength) / (len(f) + strength)) > 0.5}
    kept = [(i, t) for n, (i, t, h) in enumerate(rows) if not failed[n] and h not in bad]
    best = {}
    for label, (i, t) in zip(brute_classes(kept), kept):
        if label not in best or (i is None, i) < (best[label][0] is None, best[label][0]):
            best[label] = (i, t)
    return [(i, t) for i, t in best.values() if not brute_hits(t, items)[1]]


def digests(rows):
    bpe = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    out = []
    for i, t in rows:
        ids = bpe.encode_ordinary(t)
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_pipeline_equals_brute_force(spark):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, SMOKE, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SMOKE, "benchmark").collect()]
    got = [tuple(r) for r in corpus_pipeline.run(spark, SMOKE).collect()]
    assert sorted(got, key=repr) == digests(brute_pipeline(rows, items))


def test_stages_keep_the_columns_and_take_awkward_and_empty_tables(spark):
    for rows in (None, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMOKE)
            if name != "encoding":
                assert out.columns == docs.columns
            docs = out
        assert docs.count() == (0 if rows == [] else len({r.doc_id for r in docs.collect()}))


def test_native_queries_run_no_python_and_nothing_is_kept_in_one_place(spark):
    import pathlib

    import loanscore.llm

    for name in ("op2_url_equivalence", "op4_host_quality", "op7_chat_parts"):
        plan = queries.registry()[name](spark, SMOKE)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas")), name
    for path in pathlib.Path(loanscore.llm.__file__).parent.glob("*.py"):
        source = path.read_text()
        for banned in ("localCheckpoint", ".collect()", "toPandas", "crossJoin", "broadcast(", "mkdtemp", ".rdd"):
            assert banned not in source, (path.name, banned)
