"""Row selection, name recovery, jobs; and the library without the training-data folders."""

import shutil
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from tagframe.functions import extract, pricing
from tagframe.operators import elections, jobs, recovery, rules, selection
from tagframe.sources.tables import spread

REPO = Path(__file__).resolve().parent.parent


def test_without_training_data_folders(tmp_path):
    away = shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "corpus_pipeline.py"))
    for pipeline in (False, True):  # the pipeline's module may still be there
        if pipeline:
            (away / "corpus_pipeline.py").write_text("from tagframe.llm import toxicity\n")
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not set(e.oracle_sql()) - set(q) and 'pipeline' not in q"], cwd=away, capture_output=True, text=True)
        assert said.returncode == 0, said.stderr


def test_pool_and_best(spark):
    df = spark.createDataFrame([(1, "a", ["b", "a", "", None, "c"]), (2, "x", None)], "k long, before string, texts array<string>")
    got = {r.k: r.pool for r in df.select("k", recovery.pool(F.col("before"), F.col("texts"), 4).alias("pool")).collect()}
    assert got == {1: ["a", "b"], 2: ["x"]}
    rows = [(1, 0, False, 0.9, 0.1, "n"), (1, 1, True, 0.2, 0.0, "yes"), (2, 0, False, 0.5, 0.1, "first"), (2, 1, False, 0.5, 0.1, "tie")]
    best = recovery.best_of_pool(spark.createDataFrame(rows, "g long, ordinal long, accepted boolean, score double, margin double, name string"), ["g"])
    assert {r.g: r.name for r in best.collect()} == {1: "yes", 2: "first"}


def test_tails_stop_early(spark):
    rows = [(1, i, 10.0 - i, f"t{i // 2}", "de" if i == 3 else "", "5g" if i in (1, 9) else "", i == 11) for i in range(12)]
    df = spark.createDataFrame(rows, "track_id long, ordinal long, score double, text string, country string, unit string, glass boolean")
    (r,) = recovery.tails(df, ["track_id"], 3).collect()
    assert (r.country, r.unit, r.glass, r.texts) == ("de", "5g", True, ["t0", "t1", "t2"])
    (r,) = recovery.tails(df.where("ordinal = 0"), ["track_id"]).collect()
    assert (r.country, r.unit, r.texts) == ("", "", ["t0"])


def test_rules_change_values(spark):
    """The repaired values themselves, worked out by hand."""
    names = "price_default string, price_card string, discount_amount string, price1_qr string, price2_qr string, price4_qr string"
    rows = [("1000", "149", "-25%", "", "", ""), ("200", "149", "-25%", "", "", ""), ("2000", "199", "", "", "", ""), ("3", "149", "", "x", "y", ""), ("", "149", "", "", "", "")]
    out = rules.with_sanity(spark.createDataFrame(rows, names)).collect()
    # 149.99 / (1 - 0.255) = 201.33: the nearest price that ends in 9 is 201.29.
    assert [(r.price_default, r.price_card) for r in out] == [("201.29", "149.99"), ("200.99", "149.99"), ("200.09", "199.99"), ("", "149.99"), ("", "149.99")]
    assert [a.source for a in out[0].audit if a.field == "price_default"][0] == "discount_relation_default_repair"


def test_closest_ties_and_low_values(spark):
    values = [0.0, 0.05, 0.14, 9.99, 10.04, 100.5, 1234.56, 0.09, 99.94, 7.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(pricing.closest(F.col("v"))).collect()]
    for v, p in zip(values, got):
        every = [w + e / 100.0 for w in range(max(0, int(v) - 1), int(v) + 2) for e in range(9, 100, 10)]
        assert p == min(every, key=lambda x: (abs(x - v), x))


def test_support_ties(spark):
    rows = [(1, 5.0, 1.0, True, False, 3, 0, 0.1, 10), (1, 5.0, 2.0, False, False, 4, 0, 0.2, 20), (1, 7.0, 2.05, False, False, 1, 0, 0.3, 30)]
    atoms = spark.createDataFrame(rows, "g long, value double, atom_score double, close boolean, marker boolean, ordinal long, atom int, score double, timestamp_ms long")
    (r,) = elections._support(atoms, ["g"], F.col("top") + F.col("n") * 0.07).collect()
    assert (r.value, r.support, r.score, r.ordinal) == (5.0, 2, 0.2, 4)


def test_missing_time_is_zero(spark):
    (r,) = spark.createDataFrame([(None, "400")], "a string, b string").select(extract.time_bonus(F.col("a"), F.col("b")).alias("t")).collect()
    assert (r.t.bonus, r.t.diff) == (0.25, 400)


def test_states_and_formats(spark):
    e = spark.createDataFrame([(1, [(1, "running"), (2, "queued"), (3, "running"), (4, "uploading"), (5, "done"), (6, "queued")]), (2, [])], "j long, e array<struct<at:long,state:string>>")
    assert {r.j: r.s for r in e.select("j", jobs.final_state(F.col("e")).alias("s")).collect()} == {1: "done", 2: "uploading"}
    rows = selection.serialised(spark.createDataFrame([(0.123456, None, 1.0)], "score double, x_min double, other double"))
    assert tuple(rows.first()) == ("0.1235", "", 1.0) and selection.reread(rows).first().score == 0.1235
    (r,) = spark.createDataFrame([(2, "b"), (1, "a")], "n long, v string").agg(jobs.final_json(spark.createDataFrame([], "n long, v string"), ["n"]).alias("j")).collect()
    assert r.j == '{"rows":[{"n":1,"v":"a"},{"n":2,"v":"b"}],"count":2}'


def test_spread_small_tables(spark):
    small = spark.range(10).coalesce(1)
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
