import corpus_pipeline
import pytest

import __spark_entry__ as entry
from tablewright.llm import catalogue, decontaminate, neardup, quality
from tablewright.llm.common import ORACLE, QUERIES, table
from tablewright.session import materialize
from tests import oracle
from tests.llm.conftest import edge_rows
from tests.llm.test_neardup import brute
from tests.llm.test_packing_sharding import check_packed
from tests.llm.test_secrets import spans

SF = "/root/testdata/sf0.001"


def staged(spark, docs):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), "stage"))
    return out


def test_stages_on_awkward_documents(spark, edge):
    benchmark = table(spark, SF, "benchmark").select("text").limit(1).first()[0]
    leak = edge.limit(1).selectExpr("999L AS doc_id", "'en' AS lang", "'a' AS source", "0L AS n_chars")
    rows = [r[:1] + (r[1],) + r[2:] for r in edge_rows()]
    rows.append((999, rows[30][1] + " " + benchmark, *rows[30][2:]))
    docs = spark.createDataFrame(rows, edge.schema)
    stages = staged(spark, docs)
    assert all(s.columns == docs.columns for s in stages[:-1])
    texts = [sorted(((r["doc_id"], r["text"]) for r in s.collect()), key=str) for s in stages[:-1]]

    kept = {(r["doc_id"], r["text_hash"]) for r in quality.verdicts(docs).where("kept").collect()}
    assert 0 < len(texts[1]) < len(texts[0]) and len({i for i, _ in texts[1]}) == len({i for i, _ in kept})
    want = brute(texts[1], 5)
    assert texts[2] == sorted((k for k, v in want.items() if v[2]), key=str)
    assert texts[3] == [x for x in texts[2] if x[0] != 999]
    assert [i for i, _ in texts[4]] == [i for i, _ in texts[3]]
    for (_, before), (_, after) in zip(texts[3], texts[4]):
        assert (before == after) == (not spans(before))
    check_packed(stages[-1].collect(), [t for _, t in texts[4]], 2048)


def test_stages_on_nothing(spark, nothing):
    for s in staged(spark, nothing)[1:]:
        assert s.isEmpty()


def test_run_is_its_stages(spark):
    docs = table(spark, SF, "documents")
    by_stage = staged(spark, docs)[-1].drop("sequence_id", "offset")
    whole = corpus_pipeline.run(spark, SF).drop("sequence_id", "offset")
    assert whole.exceptAll(by_stage).isEmpty() and by_stage.exceptAll(whole).isEmpty()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = oracle.connect(SF)
    cursor = con.execute(ORACLE[name])
    columns, want = [d[0] for d in cursor.description], cursor.fetchall()
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert oracle.bag(df.columns, df.collect()) == oracle.bag(columns, want)


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
