"""The steps end to end, sinks, lineage and models."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from basketline import schemas
from basketline.ml import forests, models
from basketline.operators import enrich, labels, metrics, normalize, validate
from basketline.plans import curate, evaluate, ingest, train
from basketline.session import checkpoint_dir
from basketline.sources import lineage, readers, sinks
from suite import fixtures as fx

LABEL = "target_repeat_180d"


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    """Bronze, quarantine and gold tables of the smallest data."""
    root = tmp_path_factory.mktemp("store")
    paths = {name: str(root / name) for name in ("bronze", "quarantine", "gold", "log", "csv", "models")}
    raw = fx.raw_lines(spark, sf_dir)
    for _ in range(2):  # the second run replaces the first
        counts = ingest.ingest(
            raw,
            paths["bronze"],
            paths["quarantine"],
            batch_id="b1",
            partitions=("country", "invoice_year"),
            log_path=paths["log"],
            source_name="raw",
        )
    paths["counts"] = counts
    bronze = readers.read_bronze(spark, paths["bronze"])
    paths["curated"] = curate.curate(
        bronze,
        paths["gold"],
        fx.dim(spark, sf_dir),
        "broadcast",
        horizon_days=180,
        csv_path=paths["csv"],
        log_path=paths["log"],
    )
    return paths


def test_ingest_counts_and_repeat(spark, store):
    counts = store["counts"]
    assert (counts.valid, counts.rejected, counts.total) == (5634, 366, 6000)
    assert readers.read_bronze(spark, store["bronze"]).count() == 5634
    quarantine = spark.read.schema(schemas.QUARANTINE).parquet(store["quarantine"])
    assert quarantine.count() == 366 and quarantine.filter("validation_reason IS NULL").count() == 0


def test_bronze_read_prunes_partitions(spark, store):
    df = readers.read_bronze(spark, store["bronze"], ["NATION_3"], date(1996, 3, 15), date(1997, 2, 10))
    everything = readers.read_bronze(spark, store["bronze"])
    expected = everything.filter(
        "country = 'NATION_3' AND invoice_ts >= '1996-03-15' AND invoice_ts < '1997-02-11'"
    )
    assert df.count() == expected.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "invoice_year" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(invoice_ts" in plan.split("PushedFilters")[1]


def test_numeric_looking_country_stays_text(spark, tmp_path):
    lines = validate.valid_lines(
        normalize.normalise(
            spark.createDataFrame(
                [("1", "A", "d", "2", "2010-12-01 08:26:00", "1.5", "7", "01")],
                ", ".join(f"{c} string" for c in schemas.SOURCE_COLUMNS.values()),
            )
        )
    )
    sinks.write_bronze(lines, str(tmp_path / "b"))
    assert readers.read_bronze(spark, str(tmp_path / "b")).first().country == "01"
    sinks.write_bronze(lines, str(tmp_path / "b"))
    assert readers.read_bronze(spark, str(tmp_path / "b")).count() == 1  # the same rows are the same batch


def source_file(path, *lines: str):
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
    path.write_text("\n".join([header, *lines]) + "\n")


def test_a_repeated_ingest_replaces_its_batch(spark, tmp_path):
    """Without any argument: the batch is that of the files read. Other batches stay and are read as one table."""
    bronze, quarantine = str(tmp_path / "bronze"), str(tmp_path / "quarantine")

    def run(name):
        return ingest.ingest(readers.read_source(spark, str(tmp_path / name)), bronze, quarantine)

    def stored():
        rows = readers.read_bronze(spark, bronze).select("invoice_no", "country").collect()
        return sorted(map(tuple, rows)), spark.read.schema(schemas.QUARANTINE).parquet(quarantine).count()

    source_file(tmp_path / "a.csv", "1,A,x,2,2010-12-01,2.5,7,France", "2,B,x,2,2010-12-01,2.5,7,Japan", "3,C,x,0,2010-12-01,2.5,7,EIRE")
    source_file(tmp_path / "b.csv", "4,D,x,2,2011-12-01,2.5,7,France", "5,E", "6,F,x,1,nil,1,1,Oz")
    for _ in range(2):
        counts = run("a.csv")
        assert (counts.valid, counts.rejected, counts.reasons) == (2, 1, {"quantity_zero": 1})
        assert stored() == ([("1", "France"), ("2", "Japan")], 1)
    for _ in range(2):
        assert run("b.csv").reasons == {"corrupt_record": 1, "invoice_date_invalid": 1}
        assert stored() == ([("1", "France"), ("2", "Japan"), ("4", "France")], 3)
    # a file that changed is still its batch: partitions that it has no rows for any more are gone with it
    source_file(tmp_path / "a.csv", "1,A,x,2,2010-12-01,2.5,7,France")
    assert run("a.csv").total == 1 and stored() == ([("1", "France"), ("4", "France")], 2)

    known = {r.ingest_batch: r for r in sinks.batches(spark, bronze).collect()}
    assert sorted(r.row_count for r in known.values()) == [1, 1]
    assert {r.details["corrupt_record"] for r in sinks.batches(spark, quarantine).collect()} == {"0", "1"}
    one = readers.read_bronze(spark, bronze, batches=[sinks.batch_of(readers.read_source(spark, str(tmp_path / "b.csv")))])
    assert [r.invoice_no for r in one.collect()] == ["4"]


def test_ingest_of_nothing(spark, tmp_path):
    source_file(tmp_path / "a.csv")
    paths = str(tmp_path / "bronze"), str(tmp_path / "quarantine")
    assert ingest.ingest(readers.read_source(spark, str(tmp_path / "a.csv")), *paths).total == 0
    assert readers.read_bronze(spark, paths[0]).count() == 0


def test_ingest_reads_its_source_twice(spark, tmp_path):
    """Once for each of the two writes: rows are counted in what was written."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    source_file(tmp_path / "a.csv", "1,A,x,2,2010-12-01,2.5,7,France", "3,C,x,0,2010-12-01,2.5,7,EIRE")
    raw = readers.read_source(spark, str(tmp_path / "a.csv"))
    watched = raw.mapInArrow(counted, raw.schema)
    counts = ingest.ingest(watched, str(tmp_path / "bronze"), str(tmp_path / "quarantine"))
    assert (counts.valid, counts.rejected, reads.value) == (1, 1, 2)
    detected = ingest.ingest(watched, str(tmp_path / "bronze"), str(tmp_path / "quarantine"), date_formats="detect")
    assert detected == counts and reads.value == 5


def test_curate_equals_operators(spark, sf_dir, store):
    assert store["curated"] == 5581
    gold = {name: readers.read_gold(spark, f"{store['gold']}/{name}") for name in curate.TABLES}
    sales = metrics.sales_metrics(fx.enriched(spark, sf_dir))
    assert gold["sales_metrics"].exceptAll(sales).count() == sales.exceptAll(gold["sales_metrics"]).count() == 0
    dq = metrics.dq_metrics(fx.valid(spark, sf_dir))
    assert gold["dq_metrics"].exceptAll(dq).count() == dq.exceptAll(gold["dq_metrics"]).count() == 0
    assert gold["model_features"].columns == [*schemas.MODEL_FEATURES.fieldNames()[:-1], LABEL]
    exported = spark.read.option("header", True).csv(f"{store['csv']}/sales_metrics_csv")
    assert exported.columns == gold["sales_metrics"].columns and exported.count() == sales.count()


def test_a_country_twice_in_the_dimension_is_an_error(spark, store, tmp_path):
    dim = enrich.country_dim(spark)
    bronze = readers.read_bronze(spark, store["bronze"])
    with pytest.raises(ValueError, match="more than one row of EIRE"):
        curate.curate(bronze, str(tmp_path / "gold"), dim.unionByName(dim.filter("country = 'EIRE'")))


def test_curated_lines_do_not_depend_on_the_columns_taken(spark, sf_dir):
    few = fx.enriched(spark, sf_dir, "line_total")
    full = fx.enriched(spark, sf_dir).select(*few.columns)
    assert few.exceptAll(full).count() == full.exceptAll(few).count() == 0


def test_layout_options(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    sinks.write_table(df, str(tmp_path / "t"), 4, ["k"])
    assert readers.read_gold(spark, str(tmp_path / "t")).count() == 100
    sinks.write_single_file(df, str(tmp_path / "s"))
    assert len(list((tmp_path / "s").glob("part-*.parquet"))) == 1
    with pytest.raises(ZeroDivisionError), sinks.persisted(df) as (kept,):
        assert kept.count() == 100 and kept.is_cached
        raise ZeroDivisionError
    assert not df.is_cached


def test_lineage(spark, store):
    with pytest.raises(RuntimeError), lineage.recorded(spark, store["log"], "curate", "in", "out"):
        raise RuntimeError("boom")
    log = lineage.read_log(spark, store["log"])
    latest = {r.run_name: r for r in lineage.latest_runs(log).collect()}
    assert latest["curate"].failed and latest["curate"].extra["error"] == "boom"
    assert not latest["ingest"].failed and latest["ingest"].extra["invalid_rows"] == "366"
    health = {r.run_name: (r.runs, r.failures) for r in lineage.run_health(log).collect()}
    assert health == {"ingest": (2, 0), "curate": (2, 1)}
    assert [(r.join_mode, r.runs) for r in lineage.runtime_by_join_mode(log).collect()] == [("broadcast", 1)]


def test_train_save_load_evaluate(spark, store):
    features = readers.read_gold(spark, f"{store['gold']}/model_features")
    small = {"numTrees": 5, "maxDepth": 3}
    training = train.train(
        features,
        store["models"],
        LABEL,
        estimators={
            "mllib_lr": models.logistic_regression(LABEL, maxIter=5),
            "mllib_gbt": models.boosted_trees(LABEL, maxIter=2, maxDepth=2),
        },
        control={"sample_rf": models.random_forest(LABEL, **small)},
        tuning={
            "estimator": models.random_forest(LABEL, **small),
            "grid": {"maxDepth": (2, 3)},
            "folds": 2,
            "parallelism": 2,
        },
    )
    assert set(training.fitted) == {"mllib_lr", "mllib_gbt", "sample_rf", train.TUNED}
    vector = training.train.first().features
    regions, countries = (len(m) for m in training.features.stages[1].labelsArray)
    assert len(vector) == 11 + (regions + 1) + (countries + 1)

    path = f"{store['models']}/{train.TUNED}"
    _, _, scored = evaluate.scored_test_split(features, path, LABEL)
    before = {(r.invoice_no, r.invoice_ts): r.score for r in training.scored(train.TUNED).collect()}
    after = {(r.invoice_no, r.invoice_ts): r.score for r in scored.collect()}
    assert before == after
    table = evaluate.evaluate(features, path, f"{store['models']}/evaluation", LABEL, replicates=5)
    values = {r.metric: r.value for r in table.collect()}
    assert values["test_count"] == len(after)
    assert values["auc_ci_low_95"] <= values["auc_ci_median"] <= values["auc_ci_high_95"]
    saved = spark.read.parquet(f"{store['models']}/model_metrics").collect()
    tuned = next(r for r in saved if r.model_name == train.TUNED)
    assert tuned.auc == values["test_auc"] and tuned.f1_weighted == values["test_f1_weighted"]


def test_forward_folds_never_train_on_later_rows(spark, store):
    features = readers.read_gold(spark, f"{store['gold']}/model_features")
    training = train.prepare(features, LABEL)
    both = training.train.unionByName(training.valid)
    blocks = models.forward_folds(both)
    spans = {r.block: r for r in blocks.groupBy("block").agg(
        F.min("invoice_ts").alias("first"), F.max("invoice_ts").alias("last"), F.count("*").alias("n")).collect()}
    assert set(spans) == {0, 1, 2, 3} and sum(r.n for r in spans.values()) == both.count()
    assert all(spans[k].last < spans[k + 1].first for k in range(3))
    assert max(r.n for r in spans.values()) < 1.3 * min(r.n for r in spans.values())
    small = models.random_forest(LABEL, numTrees=3)
    found = models.time_validate(both, small, {"maxDepth": (1, 3)}, label=LABEL, parallelism=2)
    assert [p["maxDepth"] for p in found.params] == [1, 3] and len(found.fold_scores) == 3
    test = blocks.filter("block = 2")
    fitted = small.copy({small.maxDepth: 3}).fit(blocks.filter("block < 2"))
    assert found.fold_scores[1][1] == pytest.approx(models.evaluator(LABEL).evaluate(fitted.transform(test)), abs=0.05)
    train.tune(training, "forward", forward=True, estimator=small, grid={"maxDepth": (1, 3)})
    assert training.scored("forward").count() == training.test.count()


def test_grid_points_of_a_forest_share_one_fit(spark, store, monkeypatch):
    """The largest point equals its own fit, a cut to one tree equals that tree cut, and each other setting is fitted once a fold."""
    training = train.prepare(readers.read_gold(spark, f"{store['gold']}/model_features"), LABEL)
    both = training.train.unionByName(training.valid)
    forest, fits = models.random_forest(LABEL, numTrees=5), []
    plain = type(forest)._fit
    monkeypatch.setattr(type(forest), "_fit", lambda self, rows: fits.append(self.getMaxDepth()) or plain(self, rows))
    grid = {"maxDepth": (2, 6), "numTrees": (3, 5), "minInstancesPerNode": (1, 4)}
    found = models.cross_validate(both, forest, grid, folds=2, label=LABEL)
    assert len(found.avgMetrics) == 8 and sorted(fits[:-1]) == [6, 6, 6, 6]
    model = plain(forest.copy({forest.maxDepth: 6}), both)
    sizes = [(6, 5), (0, 5), (6, 3)]
    scored = forests.grid_scores(model, both, sizes, LABEL).select("scores").collect()
    raw = [r.raw for r in model.transform(both).select(vector_to_array("rawPrediction").alias("raw")).collect()]
    assert [r.scores[0] for r in scored] == pytest.approx([r[1] for r in raw])
    assert len({r.scores[1] for r in scored}) == 1
    small = plain(forest.copy({forest.maxDepth: 2, forest.featureSubsetStrategy: "all"}), both)
    large = plain(forest.copy({forest.maxDepth: 6, forest.featureSubsetStrategy: "all"}), both)
    cut = forests.grid_scores(large, both, [(2, 5)], LABEL).collect()
    raw = [r.raw for r in small.transform(both).select(vector_to_array("rawPrediction").alias("raw")).collect()]
    assert [r.scores[0] for r in cut] == pytest.approx([r[1] for r in raw])


def test_control_without_both_classes_has_a_row_of_zeros(spark, store):
    features = readers.read_gold(spark, f"{store['gold']}/model_features")
    training = train.prepare(features, LABEL)
    training.train = training.train.filter(f"{LABEL} = 1")
    train.fit_control(training, {"sample_lr": models.logistic_regression(LABEL)})
    assert [tuple(r) for r in training.comparison().collect()] == [("sample_lr", 0.0, 0.0, 0.0)]


def test_unseen_category_is_scored(spark, store):
    features = readers.read_gold(spark, f"{store['gold']}/model_features")
    model = models.fit(features.filter("region <> 'unknown'"), models.logistic_regression(LABEL, maxIter=2))
    assert models.score(model, features).count() == features.count()


def test_checkpoint_dir_is_the_one_of_the_session(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_default_dimension_has_unique_countries(spark):
    dim = enrich.country_dim(spark)
    assert dim.count() == dim.select("country").distinct().count() == 10
    assert labels.DEFAULT_HORIZON_DAYS == 30


def test_a_large_forest_keeps_no_node_ids(spark, store, monkeypatch):
    """Its node ids would take more disk than its rows; without them the trees are the same. Vectors get a task for each core."""
    prepared = train.prepare(readers.read_gold(spark, store["gold"] + "/model_features"), LABEL)
    assert prepared.train.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    forest = models.random_forest(LABEL, numTrees=5, maxDepth=6)
    assert models.within_disk(forest, prepared.train).getCacheNodeIds()
    kept = models.fit_on(prepared.features, prepared.train, forest).stages[-1]
    monkeypatch.setattr(models, "NODE_ID_BYTES", 0)
    assert not models.within_disk(forest, prepared.train).getCacheNodeIds()
    walked = models.fit_on(prepared.features, prepared.train, forest).stages[-1]
    assert kept.toDebugString == walked.toDebugString
