"""The pipeline's stages, each on its own input, and its last result."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF).cache()
        ids = {r[0] for r in before.select("doc_id").collect()}
        assert {r[0] for r in after.select("doc_id").collect()} <= ids
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == names
        if name == "near_duplicates":
            assert after.count() < before.count()
        if name == "secrets":
            assert after.count() == before.count()
            assert after.where(F.col("text").rlike("AKIA[A-Z0-9]{16}|token = \"[0-9a-f]{40}")).count() == 0
        before = after
    assert before.count() == corpus_pipeline.run(spark, SF).count()
    assert before.agg(F.sum("taken")).first()[0] > 0


def test_pipeline_empty_and_null(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 3), (1, None, "en", None, 3)], docs.schema)
    for df in (docs.limit(0), odd):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            assert out.count() <= df.count()


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def stage_rows(spark, rows):
    """The near-duplicate stage on (doc_id, text): what stays, sorted."""
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS).repartition(3)
    out = corpus_pipeline.one_of_each_group(spark, df, SF)
    assert out.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_near_duplicate_stage_links_from_080(spark):
    """Against all pairs at 0.80; many pairs lie between 0.80 and 0.85."""
    r = random.Random(11)
    docs = []
    for i in range(40):
        base = [f"w{r.randrange(9000)}" for _ in range(104)]
        docs.append(base)
        for edits in (1, 2, 2, 3):
            d = list(base)
            for k in range(edits):
                d[5 + 13 * k + r.randrange(3)] = f"x{i}{k}{r.randrange(9)}"
            docs.append(d)
    sets = [{tuple(d[k : k + 5]) for k in range(len(d) - 4)} for d in docs]
    root, between = list(range(len(docs))), 0

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in range(len(docs)):
        for b in range(a + 1, len(docs)):
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if 100 * both >= 80 * either:
                between += 100 * both < 85 * either
                x, y = sorted((find(a), find(b)))
                root[y] = x
    texts = [" ".join(d) for d in docs]
    assert between > 20
    assert stage_rows(spark, enumerate(texts)) == sorted(((i, texts[i]) for i in range(len(docs)) if find(i) == i), key=str)


def test_near_duplicate_stage_decides_by_row(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    near = b.replace("b59", "x")
    rows = [(7, a), (7, a), (7, a), (2, b), (5, near), (5, c), (None, d), (None, d), (None, b), (9, None), (9, None), (3, " ")]
    want = [(7, a), (2, b), (5, c), (None, d), (9, None), (9, None), (3, " ")]
    assert stage_rows(spark, rows) == sorted(want, key=str)


def test_stages_hand_python_small_batches(spark):
    """Of 600 texts of 50 kB (30 MB) no worker gets more than about 4 MB at once, and none is lost."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    own = spark.newSession()
    docs = own.range(600, numPartitions=1).selectExpr("id AS doc_id", "repeat('abcde fghi', 5000) AS text", "'en' AS lang", "'s' AS source", "50000L AS n_chars")
    corpus_pipeline.STAGES[3][1](own, docs, SF)
    got = docs.select("text").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 600
    assert max(r["size"] for r in got) < 5 << 20

    kept = spark.newSession()
    kept.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "77")
    corpus_pipeline.STAGES[3][1](kept, docs, SF)
    assert kept.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "77"
