"""Normalise, validate, dedupe and enrich on rows written by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketline import session
from basketline.functions import casts
from basketline.operators import dedupe, enrich, normalize, validate
from basketline.sources import readers
from suite.queries import QUERIES

RAW = (
    "invoice_no string, stock_code string, description string, quantity string, invoice_date string, "
    "unit_price string, customer_id string, country string"
)
GOOD = ("1", "A", "thing", "2", "2010-12-01 08:26:00", "2.5", "17850", "France")


def raw(spark, *changes: dict):
    names = [c.split()[0] for c in RAW.split(", ")]
    return spark.createDataFrame(
        [tuple({**dict(zip(names, GOOD, strict=True)), **c}.values()) for c in changes], RAW
    )


def one(spark, column: str, **change):
    return normalize.normalise(raw(spark, change)).first()[column]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2", 2), ("2.7", 2), ("-3.9", -3), (" 7 ", 7), ("1e3", 1000), ("n/a", 0), ("nan", 0), ("inf", 0)]
    + [(None, 0), ("", 0), ("5d", 0), ("9007199254740993", 9007199254740993)],
)
def test_quantity(spark, text, expected):
    assert one(spark, "quantity", quantity=text) == expected


@pytest.mark.parametrize(
    ("text", "expected"), [("2.55", 2.55), ("x", 0.0), (None, 0.0), ("NaN", 0.0), ("Infinity", 0.0)]
)
def test_price(spark, text, expected):
    assert one(spark, "unit_price", unit_price=text) == expected


@pytest.mark.parametrize(("text", "expected"), [("17850.0", "17850"), (None, "-1"), ("guest", "-1")])
def test_customer(spark, text, expected):
    assert one(spark, "customer_id", customer_id=text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2010-12-01 08:26:00", "2010-12-01 08:26:00"),
        ("2010-12-01T08:26:00.789", "2010-12-01 08:26:00"),
        ("2010-12-01", "2010-12-01 00:00:00"),
        ("12/1/2010 8:26", "2010-12-01 08:26:00"),
        ("2/30/2010 8:26", None),
        ("13/1/2010", None),
        ("not-a-date", None),
        (None, None),
    ],
)
def test_date(spark, text, expected):
    row = normalize.normalise(raw(spark, {"invoice_date": text})).first()
    assert row.invoice_date == expected
    assert (row.invoice_ts and str(row.invoice_ts)) == expected


def test_date_pattern(spark):
    frame = normalize.normalise(raw(spark, {"invoice_date": "12/1/2010 8:26"}), date_formats=["M/d/yyyy H:mm"])
    assert frame.first().invoice_date == "2010-12-01 08:26:00"


def test_dates_do_not_depend_on_the_session_zone(spark):
    """02:30 of 14 March 2010 does not exist in New York, 01:30 of 7 November is there twice."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    texts = ["3/14/2010 2:30", "11/7/2010 1:30", "2010-03-14 02:30:00"]
    expected = ["2010-03-14 02:30:00", "2010-11-07 01:30:00", "2010-03-14 02:30:00"]
    try:
        for other in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", other)
            lines = normalize.normalise(raw(spark, *({"invoice_no": str(i), "invoice_date": t} for i, t in enumerate(texts))))
            rows = sorted(lines.collect(), key=lambda r: r.invoice_no)
            assert [r.invoice_date for r in rows] == [str(r.invoice_ts) for r in rows] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_date_formats_are_found_by_what_they_read(spark):
    def found(*texts):
        return normalize.date_formats_of(raw(spark, *({"invoice_date": t} for t in texts)))

    month_first, day_first = casts.KNOWN_FORMATS[:2]
    assert found("3/4/2011 10:00", "13/4/2011", "x", None)[0] == day_first
    assert found("3/4/2011 10:00:05", "3/13/2011")[0] == month_first
    assert found("1.2.2011 9:05") == ["d.M.yyyy[ H:mm[:ss]]"] and found("2011-01-02", "n/a") == []
    lines = raw(spark, {"invoice_date": "3/4/2011"}, {"invoice_date": "13/4/2011 7:05"})
    typed = normalize.normalise(lines, date_formats=normalize.date_formats_of(lines))
    assert sorted(r.invoice_date for r in typed.collect()) == ["2011-04-03 00:00:00", "2011-04-13 07:05:00"]


def test_text_defaults(spark):
    row = normalize.normalise(
        raw(spark, {"invoice_no": "\t 7 ", "stock_code": None, "description": None, "country": None})
    ).first()
    assert (row.invoice_no, row.stock_code, row.description, row.country) == ("7", "", "unknown", "unknown")


def test_reasons_and_priority(spark):
    lines = normalize.normalise(
        raw(
            spark,
            {},
            {"quantity": "-4"},
            {"quantity": "0", "invoice_date": "x"},
            {"quantity": "0", "unit_price": "0"},
            {"unit_price": "-1", "customer_id": None},
            {"customer_id": None, "stock_code": " "},
            {"stock_code": None},
            {"country": "  "},
        )
    )
    valid, rejected = validate.split(lines)
    assert valid.count() == 2 and valid.filter("is_return = 1").count() == 1
    assert sorted(r[validate.REASON] for r in rejected.collect()) == sorted(
        [
            validate.DATE_INVALID,
            validate.QUANTITY_ZERO,
            validate.PRICE_INVALID,
            validate.CUSTOMER_MISSING,
            validate.FIELD_MISSING,
            validate.FIELD_MISSING,
        ]
    )


@pytest.mark.parametrize("column", ["invoice_no", "quantity", "unit_price", "customer_id", "country"])
def test_a_null_never_loses_the_row(spark, column):
    lines = normalize.normalise(raw(spark, {}, {}))
    lines = lines.withColumn(column, F.lit(None).cast(lines.schema[column].dataType))
    valid, rejected = validate.split(lines)
    assert (valid.count(), rejected.count()) == (0, 2)


def test_transaction_id_and_survivor(spark):
    lines = raw(spark, {"quantity": "9"}, {"quantity": "2"}, {"quantity": "2", "description": "b"})
    valid = validate.valid_lines(normalize.normalise(lines))
    assert valid.select("transaction_id").distinct().count() == 1
    for parts in (1, 3):
        kept = dedupe.dedupe(valid.repartition(parts), copies="copies").collect()
        assert [(r.quantity, r.description, r.copies) for r in kept] == [(2, "b", 3)]
    assert dedupe.dedupe(valid, key_cols=("transaction_id", "quantity")).count() == 2


def test_join_strategies_agree_and_fill(spark):
    lines = validate.valid_lines(
        normalize.normalise(raw(spark, *({"country": c, "stock_code": c} for c in ("France", "Japan", "Oz"))))
    )
    dim = enrich.country_dim(spark)
    expected = [("France", "europe", 1), ("Japan", "apac", 2), ("Oz", "unknown", 3)]
    for settings in (
        {"strategy": "auto"},
        {"strategy": "broadcast"},
        {"strategy": "broadcast", "row_limit": 2},
        {"strategy": "merge"},
        {"strategy": "merge", "tasks": 1},
        {"strategy": "merge", "tasks": 64},
        {"strategy": "merge", "measured": lines.limit(1)},
    ):
        rows = enrich.enrich(lines, dim, **settings).select("country", "region", "shipping_risk_score")
        assert sorted(map(tuple, rows.collect())) == expected
    with pytest.raises(ValueError):
        enrich.enrich(lines, dim, "nested")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_plans(spark):
    lines = validate.valid_lines(normalize.normalise(raw(spark, {})))
    dim = enrich.country_dim(spark)
    assert "BroadcastHashJoin" in plan_of(enrich.enrich(lines, dim, "broadcast"))
    assert "SortMergeJoin" in plan_of(enrich.enrich(lines, dim, "broadcast", row_limit=2))
    merged = plan_of(enrich.enrich(lines, dim, "merge"))
    assert "SortMergeJoin" in merged and "hashpartitioning(country" in merged and "salt" in merged


def test_merge_join_spreads_a_heavy_country(spark):
    """89 % of the lines are of one country, and some have none: no task gets much more than its share."""
    country = F.when(F.col("id") % 100 < 85, "France").when(F.col("id") % 100 < 95, F.concat(F.lit("c"), F.col("id") % 7))
    lines = spark.range(20_000).select(F.col("id").cast("string").alias("invoice_no"), country.alias("country"))
    lines = lines.unionByName(lines.limit(8_000).withColumn("country", F.lit("France")))
    heavy = {r.country: r.salts for r in enrich.heavy_keys(lines, 16).collect()}
    assert set(heavy) == {"France"} and heavy["France"] in (14, 15)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        joined = enrich.enrich(lines, enrich.country_dim(spark), "merge")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert sum(sizes) == 28_000 and max(sizes) < 4 * 28_000 / 16
        assert joined.filter("region = 'europe'").count() == lines.filter("country = 'France'").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_broadcast_of_too_much_is_told(spark, caplog):
    dim = enrich.country_dim(spark)
    assert enrich.effective("broadcast", dim) == "broadcast" and not caplog.records
    assert enrich.effective("broadcast", dim, row_limit=2) == "merge" and "more than 2 rows" in caplog.text


def test_dedupe_folds_copies_before_the_shuffle(spark):
    valid = validate.valid_lines(normalize.normalise(raw(spark, {})))
    plan = plan_of(dedupe.dedupe(valid))
    assert "partial_min" in plan and "Window" not in plan


def test_blank_country_is_repaired(spark):
    frame = spark.createDataFrame([(" ",), ("",), ("EIRE",)], "country string")
    assert [r.country for r in enrich.repair_country(frame).collect()] == ["unknown", "unknown", "EIRE"]


def test_csv_source(spark, tmp_path):
    path = tmp_path / "source.csv"
    path.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '536365,85123A,"HEART, WHITE",6,2010-12-01 08:26:00,2.55,17850,United Kingdom\n'
        "C536379,D,Discount,-1,2010-12-01 09:41:00,27.5,14527,United Kingdom\n"
    )
    lines = normalize.normalise(readers.read_source(spark, str(path)))
    rows = {r.invoice_no: r for r in lines.collect()}
    assert rows["536365"].description == "HEART, WHITE"
    assert (rows["C536379"].is_return, rows["C536379"].line_total) == (1, -27.5)
    assert normalize.record_cap(lines, 1, "invoice_no").first().invoice_no == "536365"


def write(path, header: str, *lines: str):
    path.write_text("\n".join([header, *lines]) + "\n")


HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"


def test_source_is_read_by_each_files_header(spark, tmp_path):
    """Reordered, extra, padded and repeated columns; every file by its own header."""
    source = tmp_path / "in put"
    source.mkdir()
    write(source / "a.csv", HEADER, "1,A,thing,2,12/1/2010 8:26,2.5,7,France")
    write(source / "b.csv", "Country,Note,CustomerID,UnitPrice,InvoiceDate,Quantity,Description,StockCode,InvoiceNo",
          'Japan,"x,y",8,3.5,2010-12-02,4,other,B,2')
    write(source / "c.csv", "\ufeffInvoiceNo , StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country,Country,",
          "3,C,third,5,2010-12-03,1.5,9,EIRE,Oz,")
    (source / "empty.csv").write_text("")
    lines = normalize.normalise(readers.read_source(spark, str(source)))
    rows = {r.invoice_no: r for r in lines.collect()}
    assert {no: (r.stock_code, r.quantity, r.unit_price, r.customer_id, r.country) for no, r in rows.items()} == {
        "1": ("A", 2, 2.5, "7", "France"), "2": ("B", 4, 3.5, "8", "Japan"), "3": ("C", 5, 1.5, "9", "EIRE")
    }
    assert [str(rows[no].invoice_ts.date()) for no in "123"] == ["2010-12-01", "2010-12-02", "2010-12-03"]
    assert all(r.corrupt_record is None for r in rows.values())


def test_source_without_a_column(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER.replace(",CustomerID", ""), "1,A,thing,2,2010-12-01,2.5,France")
    with pytest.raises(ValueError, match="no column CustomerID"):
        readers.read_source(spark, str(tmp_path / "a.csv"))
    lines = normalize.normalise(readers.read_source(spark, str(tmp_path / "a.csv"), missing="null"))
    assert [(r.customer_id, r.country) for r in lines.collect()] == [("-1", "France")]
    (tmp_path / "none.csv").write_text("")
    assert readers.read_source(spark, str(tmp_path / "none.csv")).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_broken_lines_are_kept_and_rejected(spark, tmp_path, fmt):
    good = "1,A,thing,2,2010-12-01,2.5,7,France"
    if fmt == "csv":
        broken = ["2,B,few", "3,C,thing,2,2010-12-01,2.5,7,France,more,cells"]
        write(tmp_path / "a", HEADER, good, *broken)
    else:
        names, cells = HEADER.split(","), good.split(",")
        whole = "{" + ", ".join(f'"{n}": "{c}"' for n, c in zip(names, cells, strict=True)) + ', "Extra": 1}'
        broken = ['{"InvoiceNo": "2", "Sto', "no json"]
        write(tmp_path / "a", whole, *broken)
    lines = normalize.normalise(readers.read_source(spark, str(tmp_path / "a"), fmt))
    valid, rejected = validate.split(lines)
    assert [r.invoice_no for r in valid.collect()] == ["1"] and "corrupt_record" not in valid.columns
    kept = {(r.corrupt_record, r[validate.REASON]) for r in rejected.collect()}
    assert kept == {(text, validate.LINE_CORRUPT) for text in broken}
    assert {r.reason: r.row_count for r in validate.reason_counts(lines).collect()} == {"valid": 1, "corrupt_record": 2}


def test_named_formats_are_mapped_too(spark, tmp_path):
    path = str(tmp_path / "p")
    frame = spark.createDataFrame([("x", "7", 3, "A")], "Extra string, InvoiceNo string, Quantity int, StockCode string")
    frame.write.parquet(path)
    with pytest.raises(ValueError, match="Description"):
        readers.read_source(spark, path, "parquet")
    row = normalize.normalise(readers.read_source(spark, path, "parquet", missing="null")).first()
    assert (row.invoice_no, row.quantity, row.stock_code, row.country) == ("7", 3, "A", "unknown")


@pytest.mark.parametrize("n", [1, 7, 40, 41, 95, 119, 120, 500])
def test_first_records_are_those_of_a_plain_read(spark, tmp_path, n):
    """Files of several blocks: the cap takes lines in file order and leaves whole blocks where they are."""
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    lines = [f"{i:04d},A,thing,2,2010-12-01,2.5,7,France" for i in range(120)]
    write(tmp_path / "a.csv", HEADER, *lines[:40])
    write(tmp_path / "b.csv", HEADER, *lines[40:])
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500b")
        capped = readers.read_source(spark, str(tmp_path), max_records=n)
        assert sorted(r.invoice_no for r in capped.collect()) == [line[:4] for line in lines[:n]]
        if n == 500:
            assert capped.rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_dedupe_folds_no_more_than_a_shuffle_partition(spark, sf_dir):
    """The first fold comes after an exchange, so that its sort is not as large as a split; the task spreads a hot key."""
    rows = spark.range(0, 4000, 1, 4).selectExpr("'same' AS transaction_id", "id % 7 AS quantity")
    plan = dedupe.dedupe(rows, copies="copies")._jdf.queryExecution().executedPlan().toString()
    first_fold = max(at for at, line in enumerate(plan.splitlines()) if "partial_min" in line)
    assert any("_task" in line and "Exchange" in line for line in plan.splitlines()[first_fold:])
    assert [tuple(r) for r in dedupe.dedupe(rows, copies="copies").collect()] == [("same", 0, 4000)]


@pytest.mark.parametrize("broadcast_hashes", [1_000_000, 0])
def test_large_dedupe_moves_only_repeated_keys(spark, monkeypatch, broadcast_hashes):
    """Few repeated keys: no exchange of whole rows is left; many: folded in slices. Either way the rows of the plain fold."""
    monkeypatch.setattr(dedupe, "BROADCAST_HASHES", broadcast_hashes)
    monkeypatch.setattr(dedupe, "SLICE_ROWS", 1000)
    rows = spark.range(0, 4000, 1, 4).selectExpr(
        "CASE WHEN id % 10 = 0 THEN 'hot' WHEN id % 10 > 1 THEN CAST(id DIV 2 AS STRING) END AS transaction_id",
        "id % 7 AS quantity", "CAST(id % 3 AS STRING) AS country", "CAST(-0.0 * id AS DOUBLE) AS unit_price",
    )
    expected = sorted(map(repr, dedupe.dedupe(rows, copies="copies").collect()))
    for tasks in (None, 9):
        found = dedupe.dedupe(rows, copies="copies", tasks=tasks, large=True)
        assert sorted(map(repr, found.collect())) == expected
        assert "Exchange hashpartitioning" not in plan_of(found) and "Range (" not in plan_of(found)
    assert dedupe.dedupe(rows, large=True).columns == rows.columns
    # zeros of two signs are one key, but have two hashes: such keys are folded the plain way
    signed = spark.sql("SELECT * FROM VALUES (0D, 1), (-0D, 2), (0D, 3) AS t(k, v)")
    assert dedupe.dedupe(signed, ["k"], copies="n", large=True).select("v", "n").collect() == [(1, 3)]


def test_large_tables_take_the_same_lines(spark, sf_dir, monkeypatch):
    names = ("dedupe_transactions", "enrich_auto", "enrich_broadcast", "enrich_merge", "invoice_features", "sales_metrics")
    expected = {name: sorted(map(repr, QUERIES[name](spark, sf_dir).collect())) for name in names}
    monkeypatch.setattr(session, "LARGE_ROWS", 100)
    for name in names:
        assert sorted(map(repr, QUERIES[name](spark, sf_dir).collect())) == expected[name], name
