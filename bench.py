"""Headline queries on the flow table, timed; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query runs once to warm
up and then twice; the smaller time counts. Results go to a sink that reads every row.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from flowmill.operators import balance, cleaning, correlation, explain, models, profile, scoring, selection
from flowmill.functions.columns import q
from flowmill.plans.prepare import CODE, ROW_KEY, fit_state, prepare
from flowmill.session import local_session, materialize
from flowmill.sources.flow_view import KEY, TARGET, flows

FOREST = {"trees": 20, "max_depth": 8}
BOOSTING = {"rounds": 3, "max_depth": 3}  # of both boosted models


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "bench")
    spark.conf.set("spark.sql.shuffle.partitions", cores)
    raw = flows(spark, sf_dir)
    p = prepare(raw, key=KEY, balancing="none")
    state = p.state
    train_raw, test_raw = p.split.train(p.clean), p.split.test(p.clean)
    train, test = materialize(p.train, "train"), materialize(p.test, "test")
    names = [c for c in test_raw.columns if c not in (ROW_KEY, TARGET)]
    model, _ = models.train_model(models.FOREST, train, state.feature_columns, CODE, state.classes, FOREST)
    bundle = models.Bundle(model, models.FOREST, state.feature_columns, list(state.classes))
    shown = selection.per_class_sample(test_raw, TARGET, 200, ROW_KEY)

    fit = lambda name: models.train_model(name, train, state.feature_columns, CODE, state.classes, BOOSTING)

    queries = {
        "missing_and_infinite": lambda: [drain(report) for report in profile.bad_cell_reports(raw)],
        "duplicate_report": lambda: drain(profile.duplicate_report(raw)),
        "class_distribution": lambda: drain(profile.class_distribution(raw)),
        "correlated_pairs": lambda: drain(correlation.correlated_pairs(raw)),
        "dedup": lambda: drain(cleaning.deduplicate(cleaning.keep_classes(raw, TARGET, ["Heartbleed"]))),
        "stratified_split": lambda: selection.stratified_split(p.clean, TARGET, hashed=ROW_KEY),
        "fitted_state": lambda: fit_state(train_raw, TARGET, state.classes, names),
        "oversampling": lambda: drain(balance.oversample(train, TARGET, state.feature_columns, ROW_KEY)),
        "forest_training": lambda: models.train_model(
            models.FOREST, train, state.feature_columns, CODE, state.classes, FOREST
        ),
        "boosted_training": lambda: fit(models.BOOSTED),
        "softmax_training": lambda: fit(models.SOFTMAX),
        "batch_score": lambda: drain(scoring.score(test_raw, bundle, state, [ROW_KEY])),
        "score_metrics": lambda: drain(
            scoring.score(test_raw, bundle, state, [TARGET]).groupBy(q(TARGET), "predicted_class").agg(F.count(F.lit(1)))
        ),
        "explain_1000": lambda: drain(explain.explain(shown, bundle, state, [ROW_KEY])),
    }
    times = {}
    for name, run in queries.items():
        took = []
        for _ in range(3):
            start = time.perf_counter()
            run()
            took.append(time.perf_counter() - start)
        times[name] = round(min(took[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "flow_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cores),
                "forest": FOREST,
                "boosting": BOOSTING,
                "features": len(state.feature_columns),
                "train_rows": train.count(),
                "test_rows": test.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
