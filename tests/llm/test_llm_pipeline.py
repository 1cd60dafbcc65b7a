import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from llm_cases import odd_texts, prose, table
from oracle import compare, duck

from faultline.llm.common import documents, stored
from faultline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_reads_all_rows(spark, name):
    rows = QUERIES[name](spark, SF)
    n = documents(spark, SF).count()
    assert rows.select("doc_id").distinct().count() == n if "decontamination" not in name else rows.count() > 0


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = documents(spark, SF)
    columns, counts, ids = docs.columns, [docs.count()], None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "packing"]
    assert counts[1] == counts[2] and counts[2] > counts[3] > counts[4] > 0
    leaks = duckdb.sql(
        f"SELECT doc_id FROM '{SF}/documents.parquet' d JOIN '{SF}/benchmark.parquet' b ON contains(d.text, b.text)"
    ).fetchall()
    assert leaks and not ids & {r[0] for r in leaks}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids


def test_empty_documents_pass_all_stages(spark):
    docs = documents(spark, SF).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0


def test_odd_rows_pass_all_stages(spark):
    """Null, empty, blank, letterless, very long and repeated texts, null and repeated ids, clashing columns."""
    texts = [prose(500 + i, 60) for i in range(30)]
    odd = [(i, t, "xx", "host") for i, t in odd_texts()] + [(50, "123 456", None, None), (51, texts[0], None, "")]
    docs = table(spark, odd + [(100 + i, t, "xx", f"s{i % 3}") for i, t in enumerate(texts)])
    columns, left = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), f"odd-{name}")
        assert docs.columns == columns
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert not left[0] & {1, 2, 3, 50}  # no letter
    assert left[0] >= {8, 9, 51, *range(100, 130)} and left[0] == left[1]
    assert {8, 9} & left[2] == {8} and {51, 100} & left[2] == {51} and left[2] == left[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == left[3]


def test_without_labels_or_benchmark_nothing_is_lost(spark, tmp_path):
    docs = table(spark, [(i, prose(i, 50)) for i in range(6)])
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), f"plain-{name}")
        assert docs.count() == 6, name


def test_the_rest_works_without_the_subpackage(tmp_path):
    top = Path(__file__).parents[2]
    shutil.copytree(top / "faultline", tmp_path / "faultline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def test_of_copies_one_keeps_its_text_through_lines_and_near_duplicates(spark):
    """Exact copies, near copies that differ in a line or by a line of their own, and a menu, on one host."""
    body = [prose(900 + k, 30, 10_000) for k in range(8)]
    exact, near, variant = "\n".join(body[:2]), "\n".join(body[2:4]), body[4:8]
    rows = [(i, exact, "xx", "host") for i in range(1, 41)]
    rows += [(100 + i, near + "\n" * (i % 3), "xx", "host") for i in range(40)]
    rows += [(200 + i, "\n".join([*variant, f"own{i} line{i}"]), "xx", "host") for i in range(40)]
    rows += [(300 + i, f"the common menu\n{prose(i, 40, 10_000)}", "xx", "host") for i in range(100)]
    docs = table(spark, rows)
    lines = stored(corpus_pipeline.without_boilerplate(spark, docs, SF), "test-copies")
    kept = [r.text for r in corpus_pipeline.one_of_each(spark, lines, SF).collect()]
    assert all(t.strip() for t in kept)
    assert [sum(p in t for t in kept) for p in body] == [1] * 8
    assert any(all(p in t for p in variant) for t in kept)
    assert sum("the common menu" in t for t in kept) <= 1
    assert sum(len(t.split()) == 40 or "menu" in t for t in kept) == 100
