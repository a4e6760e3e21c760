"""Queries next to their SQL, and the pipeline stage by stage."""

import corpus_pipeline
import oracle_check
import pytest

from shelfwise.llm import decontamination, neardup, quality, queries, toxicity
from shelfwise.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, name):
    sql = oracle_check.connect(SF).execute(queries.ORACLE_SQL[name]).fetchdf()
    assert oracle_check.difference(queries.QUERIES[name](spark, SF).toPandas(), sql) is None


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against the operator's own verdict on that input."""
    docs = table(spark, SF, "documents")
    ids = lambda d: {r["doc_id"] for r in d.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality_rules", "near_duplicates", "decontamination", "packing"]
    kept = stages["toxicity"](spark, docs, SF)
    model = toxicity.learn_model(toxicity.training_sample(docs, table(spark, SF, "labels"), None, toxicity.SAMPLE, "doc_id", "text"))
    assert ids(kept) == ids(toxicity.score_documents(docs, model).filter("predicted = 0"))
    for name, judge in (
        ("quality_rules", lambda d: quality.apply_policy(quality.rule_ledger(d)).filter("kept")),
        ("near_duplicates", lambda d: neardup.link_copies(d, size=5).filter("kept")),
        ("decontamination", lambda d: decontamination.find_contamination(d, table(spark, SF, "benchmark")).filter("not contaminated")),
    ):
        docs, kept = kept, stages[name](spark, kept, SF)
        assert kept.columns == docs.columns and ids(kept) == ids(judge(docs)) and kept.count() == len(ids(kept)), name
    packed = stages["packing"](spark, kept, SF)
    assert ids(packed) == ids(kept)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(map(str, packed.drop("sequence_id", "offset").collect()))


def test_pipeline_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_leaves_its_result_only(spark, tmp_path, monkeypatch):
    """And takes odd texts and clashing column names: a stage returns the columns that it got."""
    import os

    from shelfwise import session

    folder = str(tmp_path / "shared")
    os.makedirs(folder)
    monkeypatch.setattr(session, "shared_dir", lambda _: folder)
    given = tmp_path / "sf"
    docs = table(spark, SF, "documents").selectExpr("doc_id", "text", "lang", "source", "n_chars", "1 AS id", "'x' AS score", "2 AS length", "'k' AS kept", "3L AS n", "'t' AS token")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n"), (-4, "w " * 30_000), (None, "no id " * 20), (-4, "w " * 30_000), (-5, "ß漢😀 " * 40)], "doc_id bigint, text string")
    docs.unionByName(odd, allowMissingColumns=True).write.parquet(str(given / "documents.parquet"))
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(str(given / f"{name}.parquet"))
    found = corpus_pipeline.run(spark, str(given))
    assert found.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(found.columns)
    assert [n.rsplit("-", 1)[0] for n in os.listdir(folder)] == ["pipeline-packing"]
