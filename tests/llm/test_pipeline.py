"""The pipeline's stages on planted cases, and every query of the package against its SQL."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_queries import compare, oracle_connection
from corpusloom.llm.queries import ORACLES, QUERIES
from tests.llm import rows
from tests.llm.test_models import SECRET_TEXTS, toxic_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, oracle_connection(SF), ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_stages(spark, tmp_path):
    toxic = toxic_rows(400)
    clean = [t for _, t, y in toxic if not y and len(t.split()) > 30]
    data = [(i, t) for i, t, _ in toxic] + [(1000, clean[0] + " end"), (1001, clean[0])]
    test = " ".join(f"bench{i}" for i in range(20))
    data += [(1002, f"intro {test} outro"), (1003, "x y z " + SECRET_TEXTS[0][0]), (1004, None), (1005, ""), (1006, clean[1])]
    data += [(1006, clean[1])]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows.frame(spark, data).select(*columns).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in toxic], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, test)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema == docs.schema or out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    bad = {i for i, _, y in toxic if y}
    assert len(bad & set(kept["toxicity"])) <= 0.1 * len(bad)
    assert len({i for i, _, y in toxic if not y} & set(kept["toxicity"])) >= 0.97 * (len(toxic) - len(bad))
    assert not {1000, 1001, 1006} & set(kept["minhash"]) and {1004, 1005} <= set(kept["minhash"])
    assert len(kept["minhash"]) == len(set(kept["minhash"]))
    assert set(kept["minhash"]) - set(kept["decontamination"]) == {1002}
    assert kept["secrets"] == kept["decontamination"] or set(kept["secrets"]) == set(kept["decontamination"])
    last = {r.doc_id: r for r in docs.collect()}
    assert last[1003].text == 'x y z token = "[SECRET]" end' and last[1003].n_chars == len(last[1003].text)
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in result.collect()) == sorted(kept["secrets"])


def test_stages_judge_rows_of_shared_ids_alone(spark, tmp_path):
    toxic = toxic_rows(400)
    bad = next(t for _, t, y in toxic if y)
    rng = random.Random(4)
    fresh = lambda: " ".join(f"u{rng.randrange(10**6)}" for _ in range(40))
    test = " ".join(f"bench{i}" for i in range(20))
    near, lone, other = fresh(), [fresh() for _ in range(6)], fresh()
    tainted = f"intro {test} outro"
    shared = [(None, bad), (None, tainted), (None, near), (None, near + " tail"), (None, lone[0]), (None, lone[1])]
    shared += [(None, lone[1]), (5000, tainted), (5000, lone[2]), (5001, bad), (5001, lone[3]), (5002, other)]
    shared += [(5003, other + " tail"), (5003, lone[4]), (5004, lone[5])]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    data = [(i, t) for i, t, _ in toxic] + shared
    rows.frame(spark, data).select(*columns).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in toxic], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, test)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    mine = F.col("doc_id").isNull() | (F.col("doc_id") >= 5000)
    of = lambda name, df: [(r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)[name](spark, df, str(tmp_path)).where(mine).collect()]
    key = lambda r: (r[0] or 0, r[1])
    alike = lambda got, want: sorted(got, key=key) == sorted(want, key=key)
    assert alike(of("toxicity", docs), [r for r in shared if r[1] != bad])
    assert alike(of("decontamination", docs), [r for r in shared if r[1] != tainted])
    few = docs.where(mine & ~F.col("text").isin(bad, tainted))
    kept = of("minhash", few)
    clean = {(None, lone[0]), (None, lone[1]), (5000, lone[2]), (5001, lone[3]), (5003, lone[4]), (5004, lone[5])}
    assert len(kept) == len(set(kept)) == len(clean) + 2  # one of the null ids' near copies, and 5002
    assert clean | {(5002, other)} <= set(kept)
