"""Column functions against tables of literals."""

import math

import pytest
from pyspark.sql import functions as F

from tagframe.functions import extract, geometry, missing, numparse, pricing, qr, text


def values(spark, rows, expr, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_missing(spark):
    rows = [None, "", " NaN ", "null", "нет", "no", "1", "НЕТ", "5.0"]
    c = F.col("x")
    assert values(spark, rows, missing.core(c)) == [True, True, True, True, False, False, False, False, False]
    assert values(spark, rows, missing.dedup(c)) == [True, True, True, True, True, False, False, True, False]
    assert values(spark, rows, missing.metric(c)) == [True, True, True, True, True, True, False, True, False]
    assert values(spark, rows, missing.persist(c))[6] is False and values(spark, rows, missing.persist(c))[5] is True
    assert values(spark, ["5.0", "нет", "5.10"], missing.dedup_value(c)) == ["5", "", "5.10"]


def test_numbers(spark):
    c = F.col("x")
    assert values(spark, ["1 299.99", "12.345", "нет", "x", "-3,5"], numparse.rule_price(c)) == [1299.99, 12.34, None, None, -3.5]
    assert values(spark, ["1 299.99", "0.5", "200000", "12,5"], numparse.catalog_price(c)) == [1.0, None, None, 12.5]
    assert values(spark, ["99", "100", "100.5", "100.50", "123456", None], numparse.valid_price(c)) == [False, True, False, True, False, False]
    assert values(spark, ["1,5", " 2 ", "2x", ""], numparse.dedup_float(c)) == [1.5, 2.0, None, None]
    assert values(spark, ["p 12,345", "0", "none"], numparse.qr_price(c)) == [12.34, None, None]
    assert [str(v) for v in values(spark, [("нет", "2,675"), ("10", "3")], numparse.dedup_price(F.col("a"), F.col("b")), "a string, b string")] == ["2.68", "10.00"]
    assert values(spark, ["руб 12.5-", None], numparse.service_float(c, 7.0)) == [7.0, 7.0]


def test_text(spark):
    c = F.col("x")
    assert values(spark, ["Мёд  «Лу»-G 250г!", "nan"], text.normalized(c)) == ["мед лу g 250г", ""]
    assert values(spark, ["Кофе TESTORA молотый 0,25кг и 1 000 г"], text.units(c)) == [["250g", "1000g"]]
    assert values(spark, ["Мёд LUGOVOY цветочный для"], text.content_tokens(c)) == [["мед", "lugovoy", "цветочный"]]
    assert values(spark, ["Мёд LUGOVOY ЧАЙ"], text.brand_tokens(c)) == [["lugovoy", "чай"]]
    assert values(spark, ["abcd", "ab", ""], text.grams(c)) == [["abc", "bcd"], ["ab"], []]
    assert values(spark, ["чай мед"], text.category(text.content_tokens(c))) == ["мед"]
    assert values(spark, ["1O9 З5"], text.digit_noise(c)) == ["109 35"]
    assert values(spark, ["Джем 250r [ x ] / y"], text.surface(c)) == ["Джем 250г (x)/y"]
    assert values(spark, [("Чай черный байховый", ""), ("", "Чай"), ("Чай черный", "Чай черный"), ("Чай черный байховый", "Чай 25 черный"), ("Чай зеленый", "Кофе молотый")], text.replacement_reason(F.col("a"), F.col("b")), "a string, b string") == ["empty", "new_from_ocr", "normalized_only", "new_digits", "low_overlap"]
    assert values(spark, ["ＡＢ ё"], text.nfkc(c)) == ["AB ё"] and values(spark, ["Straße Ё!"], text.folded(c)) == ["strasse е"]
    assert values(spark, ["1,5 KG", "арт 5 г"], text.weight_display(c)) == ["1,5кг", ""]


def test_prices(spark):
    c = F.col("x")
    assert values(spark, [100.2, 100.95, 0.0], pricing.closest(c), "x double") == [100.19, 100.99, 0.09]
    assert values(spark, [(200.0, -30.0)], pricing.inferred_default(F.col("a"), F.col("b")), "a double, b double")[0] == pytest.approx(287.79, abs=0.2)
    assert values(spark, [(70.0, 100.0), (99.0, 100.0), (10.0, 100.0)], pricing.inferred_discount(F.col("a"), F.col("b")), "a double, b double") == [-30, None, None]
    assert values(spark, ["30%", "-95", "x", "-5"], pricing.percent(c)) == [-30.0, None, None, -5.0]
    assert values(spark, ["4601234567893", "96385074", "96385075", "1"], pricing.ean_ok(c)) == [True, True, False, False]
    assert values(spark, ["Мед и джем", "чай"], pricing.sku_prefix(F.lower(c))) == ["370202", "370204"]


def test_extract(spark):
    c = F.col("x")
    get = lambda f, rows: [tuple(v) for v in values(spark, rows, f(c))]
    assert get(extract.discount, ["-30%", "309%", "95%", "no"]) == [("-30%", True, 0.9), ("-30%", True, pytest.approx(0.55)), ("", False, 0.0), ("", False, 0.0)]
    assert get(extract.barcode, ["4601 234 567893", "12345678", "x"]) == [("4601234567893", True, 0.95), ("12345678", False, 0.75), ("", False, 0.0)]
    assert get(extract.printed_at, ["at 1-2-2024 10:30 x", "none"])[0][:2] == ("1.2.2024 10:30", True)
    assert get(extract.code, ["код 12 _ 34567"])[0][0] == "12_34567"
    assert get(extract.sku, ["арт. 1234567", "id 20240101 99887766554"])[0][0] == "1234567"
    assert get(extract.free_text, [" a || b\nc "])[0][0] == "a b c"
    atoms = values(spark, ["299° 90 и 150 99 и 5°"], extract.price_atoms(c))[0]
    assert [(round(a.value, 2), a.kind) for a in atoms] == [(299.9, "source_marker"), (150.99, "source_99")]


def test_token_prices(spark):
    box = lambda x, y, w, h: [[x, y], [x + w, y], [x + w, y + h], [x, y + h]]
    tokens = [("299", 0.9, box(0.0, 50.0, 60.0, 40.0)), ("99", 0.8, box(65.0, 50.0, 20.0, 20.0)), ("30%", 0.9, box(0.0, 0.0, 30.0, 20.0))]
    df = spark.createDataFrame([(tokens, "x"), ([], "цена 199,50 руб"), ([], "12")], "t array<struct<text:string,confidence:double,box:array<array<double>>>>, s string")
    large = [tuple(r[0]) for r in df.select(extract.price(F.col("t"), F.col("s"), True)).collect()]
    assert large[0][:2] == ("299.99", True) and large[0][2] == pytest.approx(0.85)
    assert large[1] == ("199.50", True, 0.55) and large[2] == ("", False, 0.0)
    small = [tuple(r[0]) for r in df.select(extract.price(F.col("t"), F.col("s"), False)).collect()]
    assert small[0][:2] == ("99", False)  # of default prices the number to the right and below leads


def test_qr(spark):
    rows = ["https://q.example/t?b=4601234567893&p1=199.99&p4=149,99", "barcode=4601234567893;price1=199", "b=4601234567893&b=1&p1=5", "https://q.example/?x=1", None]
    m = qr.parsed(F.col("x"))
    df = spark.createDataFrame([(r,) for r in rows], "x string").select("x", m.alias("m"))
    out = df.select(qr.value(F.col("m"), "qr_code_barcode"), qr.value(F.col("m"), "price1_qr"), qr.value(F.col("m"), "price4_qr"), qr.valid(F.col("x"), F.col("m"))).collect()
    assert [tuple(r) for r in out] == [("4601234567893", "199.99", "149.00", True), ("4601234567893", "199.00", "", True), ("", "5.00", "", False), ("", "", "", False), ("", "", "", False)]


def test_nms_is_the_greedy_loop(spark):
    import random

    r = random.Random(1)
    groups = []
    for g in range(30):
        boxes = []
        for i in range(r.randint(0, 12)):
            x, y = r.randint(0, 20), r.randint(0, 20)
            boxes.append((float(r.randint(0, 3)), i, float(x), float(y), float(x + r.randint(1, 15)), float(y + r.randint(1, 15))))
        groups.append((g, boxes))
    s = "array<struct<score:double,ordinal:long,x_min:double,y_min:double,x_max:double,y_max:double>>"
    df = spark.createDataFrame(groups, f"g int, b {s}")

    def iou(a, b):
        i = max(0, min(a[4], b[4]) - max(a[2], b[2])) * max(0, min(a[5], b[5]) - max(a[3], b[3]))
        u = (a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - i
        return i / u if u else 0.0

    for row in df.select("g", geometry.nms(F.col("b"), 0.4).alias("k")).collect():
        kept = []
        for b in sorted(groups[row.g][1], key=lambda b: (-b[0], b[1])):
            if all(iou(b, k) < 0.4 for k in kept):
                kept.append(b)
        assert [tuple(k) for k in row.k] == kept


def test_geometry(spark):
    df = spark.createDataFrame([(10, 4, 3), (3, 4, 2), (8, 4, 4)], "n int, t int, s int")
    assert [r[0] for r in df.select(geometry.tile_starts(F.col("n"), F.col("t"), F.col("s"))).collect()] == [[0, 3, 6], [0], [0, 4]]
    one = spark.createDataFrame([(0.0, 0.0, 2.0, 2.0, None)], "x_min double, y_min double, x_max double, y_max double, z double")
    a = geometry.box()
    z = (F.col("z"),) * 4
    r = one.select(geometry.iou(a, a), geometry.iou(a, z), geometry.centre_distance(a, z)).first()
    assert r[0] == 1 and r[1] == 0 and math.isinf(r[2])
