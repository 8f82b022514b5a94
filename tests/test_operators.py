"""Operators against loops, and every registered query's schema."""

import random

import pytest
from pyspark.sql import functions as F

from tagframe.operators import catalog, dedup, elections, lookups, motion, ordering, quality, rules, tracking
from tagframe.sources import files, sinks
from tagframe.streaming import stateful

SF = "/root/testdata/sf0.001"


def test_dedup_is_the_double_loop(spark):
    r = random.Random(3)
    for trial in range(4):
        rows = []
        for i in range(40):
            x, y = r.randint(0, 300), r.randint(0, 300)
            code = r.choice(["", "", "", str(100000 + r.randint(0, 8))])
            rows.append((i, r.choice([1.0, 2.0]), bool(code), r.sample(["aaaa", "bbbb", "cccc"], r.randint(0, 2)), r.randint(0, 5) * 1.0, code, float(x), float(y), float(x + 50), float(y + 50)))
        df = spark.createDataFrame(rows, "idx long, price double, strong boolean, tokens array<string>, identity double, barcode string, x_min double, y_min double, x_max double, y_max double")
        got = {x.idx: (x.kept_idx, x.rule) for x in dedup.drops(df).collect()}
        want = {}
        by = {}
        for row in rows:
            if row[5]:
                by.setdefault(row[5], []).append(row)
        for group in by.values():
            if len(group) == 2:
                keep = max(group, key=lambda x: (x[4], -x[0]))
                for x in group:
                    if x is not keep:
                        want[x[0]] = (keep[0], "exact_barcode")
        first = set(want)
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                if a[0] in want or b[0] in want or a[1] != b[1] or a[2] == b[2]:
                    continue
                w, h = min(a[8], b[8]) - max(a[6], b[6]), min(a[9], b[9]) - max(a[7], b[7])
                inter = max(0, w) * max(0, h)
                near = inter / (5000 - inter) >= 0.25 or ((a[6] - b[6]) ** 2 + (a[7] - b[7]) ** 2) ** 0.5 <= 90
                if near and set(a[3]) & set(b[3]):
                    weak, strong = (a, b) if b[2] else (b, a)
                    want.setdefault(weak[0], (strong[0], "same_price_spatial_identity"))
        assert set(got) == set(want) and first <= set(got)
        # Running again drops nothing new by the spatial rule.
        again = dedup.deduplicated(df)
        assert dedup.spatial_drops(again, dedup.barcode_drops(again)).count() == 0


def test_bounded_buffer_is_global_top_k(spark):
    r = random.Random(2)
    rows = [(t, i, r.choice([True, False]), r.randint(0, 4) / 4) for t in range(5) for i in range(30)]
    df = spark.createDataFrame(rows, "track_id long, arrival long, passes boolean, crop_score double")
    got = {}
    for x in quality.bounded(df, 6).collect():
        got.setdefault(x.track_id, []).append((x.candidate_rank, x.arrival))
    for t in range(5):
        kept = []
        for row in [x for x in rows if x[0] == t]:
            kept = sorted([*kept, row], key=lambda x: (-x[2], -x[3]))[:6]
        assert [a for _, a in sorted(got[t])] == [x[1] for x in kept]


def test_islands_and_grid(spark):
    rows = [("v", i, f) for i, f in enumerate([1, 1, 0, 1, 0, 0, 1, 1, 1])]
    df = spark.createDataFrame([(k, i, bool(f)) for k, i, f in rows], "k string, at long, f boolean")
    out = sorted((r.start, r.end, r.n) for r in motion.islands(df, "k", ["at"], "f", "at").collect())
    assert out == [(0, 1, 2), (3, 3, 1), (6, 8, 3)]
    w = spark.createDataFrame([("v", 3, 5)], "k string, start long, end long")
    got = sorted(r["at"] for r in motion.selected_times(df, w, "k", 4, 1, 1).collect())
    assert got == [0, 2, 3, 4, 5, 6, 8]


def test_tracking_loop_and_cascade(spark):
    rows = [("v", i, t, 0.0, 0.0, 0.9, float(x), 0.0, float(x + 50), 50.0) for i, (t, x) in enumerate([(0, 0), (0, 500), (1000, 5), (1000, 505), (2000, 8), (9000, 8)])]
    df = spark.createDataFrame(rows, "video_id string, det_id long, at long, shift_x double, shift_y double, confidence double, x_min double, y_min double, x_max double, y_max double")
    got = {r.det_id: r.track_id for r in tracking.assign(df).collect()}
    assert got == {0: 1, 1: 2, 2: 1, 3: 2, 4: 1, 5: 3}
    c = spark.createDataFrame([("k", 1, ["a"], ["a"]), ("k", 2, ["a"], []), ("k", 3, ["a", "b"], [])], "k string, ordinal long, targets array<string>, settles array<string>")
    assert sorted(r.ordinal for r in tracking.cascade(c, ["k"]).collect()) == [1, 3]


def candidates(spark, rows):
    base = [("v", 1, f, v, s, 0.9, ok, "easyocr", "price_card", "raw", ms, src, i) for i, (f, v, s, ok, ms, src) in enumerate(rows)]
    return spark.createDataFrame(base, "video_id string, track_id long, field string, value string, score double, confidence double, valid boolean, engine string, zone string, image_kind string, timestamp_ms long, source_text string, ordinal long")


def test_elections(spark):
    rows = [
        ("price_card", "299", 1.40, True, 0, "299° 99"), ("price_card", "299", 1.40, True, 600, "299 99"), ("price_card", "3099", 1.60, True, 0, "30% 9"), ("price_card", "89", 1.70, True, 0, "89"),
        ("discount_amount", "-30%", 1.20, True, 0, "309%"), ("price_default", "299.99", 1.50, True, 0, "299,99"), ("product_name", "Чай", 1.0, True, 0, ""), ("product_name", "Кофе", 1.1, True, 0, ""),
        ("barcode", "123", 9.0, True, 0, ""), ("barcode", "4601234567893", 1.0, True, 0, ""),
    ]
    template = spark.createDataFrame([("v", 1, 0), ("v", 2, 0)], "video_id string, track_id long, selected_ms long")
    out = {r.track_id: r for r in elections.submission(candidates(spark, rows), template, ["price_card", "price_default", "discount_amount", "product_name", "barcode"]).collect()}
    assert (out[1].price_card, out[1].discount_amount, out[1].product_name, out[1].barcode) == ("299.99", "-30%", "Кофе", "4601234567893")
    assert float(out[1].price_default) == pytest.approx(299.99 / 0.695, abs=6)  # 299.99 is rejected as below the card price, so inferred
    assert out[2].price_card is None


def test_rules_and_audit(spark):
    rows = [("1", "1999", "199", "", "", "", "", ""), ("2", "200", "149.5", "-25%", "", "", "", "46"), ("3", "", "", "", "", "", "", "")]
    df = spark.createDataFrame(rows, "track_id string, price_default string, price_card string, discount_amount string, price1_qr string, price4_qr string, color string, barcode string")
    out = {r.track_id: r for r in rules.applied(rules.with_sanity(df), [*rules.derived_qr(), *rules.defaults()]).collect()}
    assert (out["1"].price_default, out["1"].price_card, out["1"].price1_qr, out["1"].color) == ("199.99", "199.99", "199.99", "red") or out["1"].price_default == ""
    assert out["2"].price_card == "149.99" and out["2"].price4_qr == "149.99"
    assert [a.source for a in out["3"].audit] == ["tag_color_default"]
    assert rules.changes(rules.applied(df, rules.defaults()), ["track_id"]).count() == 3


def test_lookups(spark):
    rows = spark.createDataFrame([("a.mp4", "1", "1", "2", "3", "4", None)], "filename string, frame_timestamp string, x_min string, y_min string, x_max string, y_max string, track_id string")
    build = spark.createDataFrame([("a.mp4", "1", "1", "2", "3", "4", "t1", 1), ("a.mp4", "1", "1", "2", "3", "4", "t2", 2)], "filename string, frame_timestamp string, x_min string, y_min string, x_max string, y_max string, track_id string, o long")
    assert lookups.looked_up(rows, build, lookups.raw_key(), "track_id", "o").first().track_id == "t2"
    assert lookups.looked_up(rows, build, lookups.rounded_key(0), "track_id", "o", "first").first().track_id == "t1"
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert sorted(map(tuple, lookups.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")] == sorted(map(tuple, lookups.merged(old, new, ["k"]).collect()))


def test_catalog(spark):
    rows = spark.createDataFrame([(1, "Мёд цветочный LUGOVOY 250г"), (2, "Кофе TESTORA молотый 250г"), (3, "Джем малина")], "id long, name string")
    q = spark.createDataFrame([(10, "Мед цветочны LUGOVOY 250г"), (11, "совсем другое слово")], "id long, name string")
    best = catalog.matched(catalog.entries(q, "id", "name", unicode=True), catalog.entries(rows, "id", "name", unicode=True))
    out = {r.query_id: r for r in catalog.accepted(best).collect()}
    assert out[10].entry_id == 1 and out[10].accepted and out[10].score > 0.65
    assert 11 not in out or not out[11].accepted
    pairs = catalog.preselect(catalog.blocked(catalog.entries(q, "id", "name"), catalog.entries(rows, "id", "name")))
    full = catalog.padded(pairs, catalog.entries(q, "id", "name"), catalog.entries(rows, "id", "name"), 3)
    assert {(r.query_id, r.n) for r in full.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {(10, 3), (11, 3)}


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_bytes("﻿Code;FullName;price_regular_rub\n46;Мёд;10\n47;;5\n".encode())
    assert [(r.name, r.code, r.price_regular_rub) for r in files.catalog(spark, str(p)).collect()] == [("Мёд", "46", "10")]
    p.write_bytes("code,fullname\n46,Мёд\n".encode("cp1251"))
    assert files.catalog(spark, str(p)).first().name == "Мёд"
    j = tmp_path / "c.json"
    j.write_text('["Чай", "Кофе"]')
    assert sorted(r.name for r in files.catalog(spark, str(j)).collect()) == ["Кофе", "Чай"]
    t = tmp_path / "t.txt"
    t.write_text("timestamp_ms\n100,5\n200\n200\n")
    assert sorted(r["at"] for r in files.timestamps(spark, str(t)).collect()) == [100, 200]
    tsv = "level\tpage\n5\t1\t1\t1\t1\t1\t0\t0\t1\t1\t90\tЧай\n5\t1\t1\t1\t1\t2\t0\t0\t1\t1\t70\tчерный \"x\"\n5\t1\t1\t1\t2\t1\t0\t0\t1\t1\t3\tz"
    rows = files.tsv_lines(spark.createDataFrame([(1, tsv)], "k long, tsv string"), ["k"]).collect()
    assert [(r.text, round(r.confidence, 2)) for r in rows] == [('Чай черный "x"', 0.8)]
    head = b"....mvhd" + bytes([0, 0, 0, 0]) + bytes(8) + (1000).to_bytes(4, "big") + (32000).to_bytes(4, "big") + bytes(20)
    assert files.mp4_seconds(head) == 32.0 and files.mp4_seconds(b"x") is None
    sinks.submission_csv(spark.createDataFrame([("a", 1.5)], "filename string, price_card double"), str(tmp_path / "out"))
    back = files.csv(spark, str(tmp_path / "out"))
    assert len(back.columns) == 29 and back.first().price_card == "1.5"


def test_queue_fold():
    e = lambda kind, at: {"kind": kind, "at": at, "worker": "w", "most": 2}
    s = None
    for kind, at, want in [("enqueue", 0, "queued"), ("claim", 1, "running"), ("claim", 2, "running"), ("fail", 3, "queued"), ("claim", 4, "running"), ("fail", 5, "failed"), ("claim", 6, "failed")]:
        s = stateful.fold(s, e(kind, at))
        assert s["status"] == want
    s = stateful.fold(stateful.fold(None, e("enqueue", 0)), e("claim", 0))
    assert stateful.fold(s, e("claim", 4000))["attempts"] == 2  # the lease was over
    assert stateful.fold(None, e("complete", 0)) is None


def test_stream_tracking_equals_batch(spark):
    from tagframe.plans import QUERIES

    a, b = (sorted(map(tuple, QUERIES[n](spark, SF).select("video_id", "det_id", "track_id").collect())) for n in ("stream_track_state", "track_assign"))
    assert a == b


def test_registered_queries(spark):
    import __spark_entry__

    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(found) and len(found) > 70
    assert __spark_entry__.entry(spark).count() == 1


def test_ordering(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("b", 3, None)], "k string, i long, s double")
    assert {(r.k, r.i) for r in ordering.elect(df, ["k"], ["s", -F.col("i")], ["i"]).collect()} == {("a", 1), ("b", 3)}


def test_matched_scores_every_preselected_entry(spark):
    """Unblocked entries fill up what blocking leaves free of 900."""
    rows = spark.createDataFrame([(i, f"red green {i:03d}") for i in range(60)] + [(100, "reg gren blux"), (101, "zzzz")], "id long, name string")
    q = spark.createDataFrame([(1, "red green blux"), (2, "qqqq")], "id long, name string")
    side = [catalog.entries(x, "id", "name") for x in (q, rows)]
    got = [(r.query_id, r.entry_id) for r in catalog.matched(*side, keep=62).collect()]
    assert sorted(got) == [(i, j) for i in (1, 2) for j in (*range(60), 100, 101)]


def test_fuzzy_match_query_scores_as_the_default(spark, monkeypatch):
    from tagframe.plans import catalog as plan

    seen, own = [], catalog.padded
    monkeypatch.setattr(catalog, "padded", lambda pairs, q, e, k=900: seen.append(k) or own(pairs, q, e, k))
    plan.fuzzy_match(spark, "/root/testdata/sf0.001")
    assert seen == [900]


def test_matched_boxes_are_the_pairs_matches(spark):
    """Against the matches over all pairs: random boxes, copies, equal overlaps, one id twice, nulls."""
    import random

    import numpy as np

    from tagframe.operators import tracking

    rng = random.Random(4)
    rows = []
    for i in range(400):
        x, y = rng.choice([0, 5, 10, 40, 41.5, 90]), rng.choice([0, 3, 7, 50])
        rows.append(("a" if i % 3 else "b", i // 2 - (i % 50 == 9), bool(i % 2), float(x), float(y), x + rng.choice([6.0, 8.0, 20.0]), y + rng.choice([6.0, 9.0])))
    rows += [("c", 1, False, 0.0, 0.0, 9.0, 9.0), ("d", None, True, 0.0, 0.0, 9.0, 9.0), ("d", 2, False, None, 0.0, 9.0, 9.0), (None, 3, False, 0.0, 0.0, 9.0, 9.0), (None, 3, True, 0.0, 0.0, 9.0, 9.0)]
    expected = []
    for image in "ab":
        own = [r for r in rows if r[0] == image]
        pairs = sorted((-tracking.overlap(t[3:], p[3:]), t[1], p[1]) for t in own if not t[2] for p in own if p[2])
        truths, preds = set(), set()
        for iou, t, p in pairs:
            if iou < 0 and t not in truths and p not in preds:
                truths.add(t)
                preds.add(p)
                expected.append((image, t, p, -iou))
        of = lambda flag: (np.array([r[1] for r in own if r[2] == flag]), np.array([r[3:] for r in own if r[2] == flag]))  # noqa: E731, B023
        for most in (1, 3):
            assert tracking.greedy_matches(*of(False), *of(True), most=most) == [r[1:] for r in expected if r[0] == image]
    df = spark.createDataFrame(rows, "image_id string, id long, is_pred boolean, x_min double, y_min double, x_max double, y_max double")
    assert sorted(map(tuple, tracking.matched_boxes(df).collect())) == sorted(expected)


def test_gt_match_eval_makes_no_pairs(spark):
    from tagframe.plans import QUERIES

    plan = QUERIES["gt_match_eval"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Join" not in plan
