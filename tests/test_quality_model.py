import pytest
from pyspark.sql import functions as F

from postlake.operators import quality
from postlake.operators.features import build_tabular_features
from postlake.operators.model import (boosted_trees, fit, load_preferred, random_forest, request_features,
                                      train_and_select)
from postlake.plans.posts import posts
from postlake.session import materialise
from conftest import SF_SMALL
from oracle_util import compare, duck


def test_validate_predict(spark):
    df = spark.createDataFrame([("t", None, None, 24, 0), ("t", None, "x", 3, 7), (None, None, None, 1, 1),
                                ("ok", "u", None, 23, 6)], "title string, url string, by_author string, hour int, weekday int")
    got = [(r.valid, list(r.reasons), r.by_author) for r in quality.validate_predict(df).collect()]
    assert got == [(0, ["hour_out_of_range"], "unknown"), (0, ["weekday_out_of_range"], "x"),
                   (0, ["title_required"], "unknown"), (1, [], "unknown")]


def test_validate_search(spark):
    df = spark.createDataFrame([("q", 0), ("q", 51), ("", 5), ("q", None)], "query string, k int")
    got = [(r.valid, list(r.reasons), r.k) for r in quality.validate_search(df).collect()]
    assert got == [(0, ["k_out_of_range"], 0), (0, ["k_out_of_range"], 51), (0, ["query_required"], 5), (1, [], 10)]


def test_gates(spark):
    few = spark.range(19).withColumn("vai_bombar", F.lit(1))
    with pytest.raises(quality.GateError):
        quality.gate_min_rows(few)
    with pytest.raises(quality.GateError):
        quality.gate_two_classes(spark.range(30).withColumn("vai_bombar", F.lit(0)))


def test_fit_save_load_unseen(spark, workdir):
    feats = build_tabular_features(posts(spark, SF_SMALL))
    m = fit("random_forest", random_forest(num_trees=5, max_depth=4), feats)
    scored = m.score(feats)
    m.save(workdir)
    again = load_preferred(spark, workdir, ["champion", "random_forest"])
    a = {r.id: r.probability for r in scored.collect()}
    assert a == {r.id: r.probability for r in again.score(feats).collect()}
    with pytest.raises(FileNotFoundError):
        load_preferred(spark, workdir, ["champion"])
    req = spark.createDataFrame([(1, "Brand new author?", None, "nobody-ever", 3, 2)],
                                "id bigint, title string, url string, by_author string, hour int, weekday int")
    x = m.pipeline.transform(request_features(req)).first()
    assert x.by_author_idx is None and list(x.features.indices)[6:] == [m.encoder.offset("domain") + x.domain_idx]
    assert m.encoder.offset("by_author") + m.encoder.widths["by_author"] <= x.features.size
    out = m.score(request_features(req)).first()
    assert 0.0 <= out.probability <= 1.0 and (out.model_name, out.model_stage) == ("random_forest", "candidate")


def test_one_hot_labels_are_rows_not_literals(spark):
    """No label stands in the plan, and no one-hot vector is made dense; names of any script get their own label back."""
    from postlake.plans.catalog import QUERIES
    out = QUERIES["m2_one_hot"](spark, SF_SMALL)
    labels = {r.active for r in out.where("active IS NOT NULL").select("active").distinct().collect()} - {"no_url", "unknown", "__rare__"}
    plan = out._jdf.queryExecution().analyzed().toString() + out._jdf.queryExecution().analyzed().toJSON()
    assert len(labels) > 5 and not [x for x in labels if f'"value":"{x}"' in plan]
    assert "vector_to_array" not in plan and "array_position" not in plan


def test_active_categories_of_names_in_any_script(spark):
    from postlake.operators.model import active_categories
    feats = build_tabular_features(posts(spark, SF_SMALL)).drop("by_author", "domain")
    name = F.concat(F.element_at(F.array(*[F.lit(x) for x in "a.b,\U0001f600,\uffee,[7],\u00e9".split(",")]),
                                 F.pmod("id", F.lit(5)).cast("int") + 1), F.lit("-x"))
    feats = materialise(feats.withColumns({"by_author": name, "domain": F.lit("one.org")}), "feats")
    got = active_categories(fit("tiny", random_forest(num_trees=1, max_depth=1), feats), feats)
    wanted = feats.select("id", F.lit("by_author").alias("feature"), F.col("by_author").alias("active")).unionByName(
        feats.select("id", F.lit("domain").alias("feature"), F.col("domain").alias("active")))
    assert got.count() == 2 * feats.count() and got.exceptAll(wanted).count() == 0


def test_numbers_are_scaled_by_the_population(spark):
    feats = build_tabular_features(posts(spark, SF_SMALL))
    x = fit("tiny", random_forest(num_trees=1, max_depth=1), feats).encoded(feats)
    assert x.columns[:len(feats.columns)] == feats.columns
    x = x.select(F.unwrap_udt("features")["values"][0].alias("v"))  # title_len is the first number
    r = x.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).first()
    assert abs(r.m) < 1e-9 and abs(r.s - 1) < 1e-9


def test_the_model_depends_on_data_and_seed_alone(spark):
    feats = materialise(build_tabular_features(posts(spark, SF_SMALL)), "feats")
    scores = []
    for dealt in (feats.coalesce(1), feats.repartition(7)):
        m = fit("f", random_forest(num_trees=8, max_depth=5), dealt)
        scores.append({r.id: r.probability for r in m.score(feats).collect()})
    assert scores[0] == scores[1]


def test_boosted_rows_match_the_oracle(spark):
    from postlake.plans.catalog import ORACLE, _scored_rows
    ok, said = compare(_scored_rows(spark, SF_SMALL, "boosted_trees", boosted_trees(max_iter=3)), duck(SF_SMALL), ORACLE["m6_boosted"])
    assert ok, said


def test_train_and_select_logs_and_keeps_the_best(spark, workdir):
    feats = materialise(build_tabular_features(posts(spark, SF_SMALL)), "feats")
    said = train_and_select(feats, workdir, [("random_forest", random_forest(num_trees=5, max_depth=3)),
                                             ("boosted_trees", boosted_trees(max_iter=3, max_depth=3))])
    best = max(said["metrics"].values(), key=lambda m: m["roc_auc"])
    assert said["champion"] == best["model"] and said["roc_auc"] == best["roc_auc"]
    model = load_preferred(spark, f"{workdir}/models", ["champion"])
    assert (model.name, model.stage) == (said["champion"], "champion")
    log = spark.read.parquet(f"{workdir}/runs").where(F.col("run_id") == said["run_id"]).collect()
    metrics = {(r.model, r.key): float(r.value) for r in log if r.kind == "metric"}
    for name, row in said["metrics"].items():
        assert all(abs(metrics[name, k] - row[k]) < 1e-12 for k in ("accuracy", "f1", "roc_auc", "pr_auc"))
    assert {r.value for r in log if r.kind == "tag"} == {"random_forest", "boosted_trees"}
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_training_takes_no_texts_along_and_requests_are_checked_once(spark, workdir, monkeypatch):
    """the split is of the model's columns; a batch of requests is evaluated once, whatever is read of its result."""
    from postlake.operators import model
    from postlake.operators.features import build_tabular_features
    from postlake.plans import jobs
    from postlake.plans.posts import posts
    from postlake.sources.lake import Layout
    wide, plain = [], model.materialise
    monkeypatch.setattr(model, "materialise", lambda df, name, *a: wide.append((name, df.columns)) or plain(df, name, *a))
    features = build_tabular_features(posts(spark, SF_SMALL))
    said = model.train_and_select(features, workdir, [("random_forest", model.random_forest(num_trees=2, max_depth=2))])
    split = next(c for name, c in wide if name == "split")
    assert "title" not in split and "url" not in split and said["n_test"] > 0
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(k, None if k % 5 == 0 else f"title {k}?", None, None, k % 30, k % 7) for k in range(90)]
    requests = spark.createDataFrame(rows, "id long, title string, url string, by_author string, hour int, weekday int")
    scored, rejected = jobs.predict(spark, Layout(workdir), requests.mapInArrow(counted, requests.schema))
    ids, bad = {r.id for r in scored.collect()}, {r.id: r for r in rejected.collect()}
    assert seen.value == 90 and ids | set(bad) == set(range(90)) and not ids & set(bad)
    assert bad[5].reasons == ["title_required"] and bad[29].title == "title 29?" and bad[29].by_author == "unknown"
