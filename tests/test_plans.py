"""Plan checks and end-to-end jobs (ETL, ask, analysis)."""

import contextlib
import io
import json
import os

import pytest

from civiq.registry import REGISTRY

from .conftest import SF_SMALL

PYTHON_NODES = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "MapInArrow"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_in_plans(spark, name):
    text = plan(REGISTRY[name][0](spark, SF_SMALL))
    for node in PYTHON_NODES:
        assert node not in text, (name, node)


def test_topk_uses_partial_window_group_limit(spark):
    text = plan(REGISTRY["bm25_topk"][0](spark, SF_SMALL))
    assert "WindowGroupLimit" in text
    assert "Window " in text or "Window\n" in text or "Window (" in text


def test_mention_join_is_an_equi_join(spark):
    for name in ("mention_city", "mention_category"):
        text = plan(REGISTRY[name][0](spark, SF_SMALL))
        assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_filters_pushed_and_columns_pruned(spark):
    text = plan(REGISTRY["filtered_count_all"][0](spark, SF_SMALL))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert "EqualTo(n_name,NATION_3)" in text
    # a count reads only the columns its filters need
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in text
    assert "c_name" not in text and "o_totalprice" not in text


def test_no_cartesian_products(spark):
    for name in ["ask_batch", "stats_context", "like_search", "search_auto", "crosstab_top"]:
        assert "CartesianProduct" not in plan(REGISTRY[name][0](spark, SF_SMALL)), name


def _write_raw_csv(spark, path):
    from civiq.sources import tables as S
    raw = S.raw_reports(spark, SF_SMALL)
    raw.drop("seq").orderBy(raw.seq).coalesce(1).write.option("header", True) \
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)


def test_documents_tokenized_once(spark):
    """No tokenizer in a pushed-down filter: each text is tokenized once."""
    text = REGISTRY["term_df"][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Filter" in line or "DataFilters" in line:
            assert "regexp_extract_all" not in line, line
    from civiq.operators.index import INDEX_COLUMNS
    assert text.count("regexp_extract_all") == len(INDEX_COLUMNS)  # once per indexed column


def test_hits_broadcast_without_shuffling_documents(spark):
    """Ranked hits are broadcast into the document scan; documents are
    never hash-shuffled by id (with or without filters)."""
    for name in ("bm25_topk", "bm25_topk_filtered"):
        text = REGISTRY[name][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text, name
        assert "hashpartitioning(id" not in text, name


def test_like_ranks_per_pattern_before_fan_out(spark):
    text = REGISTRY["like_search"][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text
    assert text.count("BroadcastNestedLoopJoin") == 1  # one pass over the documents


def test_etl_ask_and_report_end_to_end(spark, scratch):
    from civiq.operators.clean import transform
    from civiq.plans.ask import ask
    from civiq.plans.etl import run_etl
    from civiq.plans.report import generate_all
    from civiq.sources import tables as S

    src = os.path.join(scratch, "raw_csv")
    _write_raw_csv(spark, src)
    out = os.path.join(scratch, "out")
    res = run_etl(spark, src, out)
    assert res["source_rows"] == S.raw_reports(spark, SF_SMALL).count()
    expected = transform(S.raw_reports(spark, SF_SMALL)).count()
    assert res["clean_rows"] == expected
    reports = spark.read.parquet(res["reports"])
    assert reports.select("id").distinct().count() == expected

    qs = S.question_fixtures(spark)
    prompts = ask(spark, qs, out, write_to=os.path.join(scratch, "prompts"))
    assert prompts.count() == qs.count()
    p1 = prompts.where("question_id = 1").first().prompt
    assert "Estadísticas agregadas:" in p1 and "Total registros:" in p1

    summary = generate_all(spark, reports, os.path.join(scratch, "analysis"))
    assert summary["rows"] == expected
    back = spark.read.json(os.path.join(scratch, "analysis", "summary")).first()
    assert back.rows == expected
    assert set(json.loads(json.dumps(summary["charts"]))) == set(back.charts.asDict())
