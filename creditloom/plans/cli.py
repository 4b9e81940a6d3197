"""Command line for ``spark-submit``:  python -m creditloom.plans.cli STAGE --root DIR ..."""

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from creditloom.operators import drift, labels, modelling, silver, splits
from creditloom.plans import monitoring, scoring, stages, training
from creditloom.sources import calendar, tables, versions
from creditloom.sources.session import tune

RULES = {"cast_first": silver.CAST_FIRST, "strip_first": silver.STRIP_FIRST}
RECIPES = {
    r.name: r
    for r in (training.RANDOM_FOREST, training.RANDOM_FOREST_SCALED, training.GRADIENT_BOOSTING, training.BOOSTED, training.LOGISTIC)
}
KEY = ["loan_id", "Customer_ID", "snapshot_date"]


def session(app: str) -> SparkSession:
    """Cluster settings (master, memory, shuffle partitions) come from spark-submit."""
    return tune(
        SparkSession.builder.appName(f"creditloom-{app}")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="creditloom")
    commands = top.add_subparsers(dest="stage", required=True)

    def command(name: str, *, span: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--root", required=True, help="folder of the tables")
        if span:
            sub.add_argument("--snapshotdate", help="one snapshot, YYYY-MM-DD")
            sub.add_argument("--start")
            sub.add_argument("--end")
        return sub

    for name in ("bronze", "backfill"):
        sub = command(name, span=True)
        for table in ("clickstream", "attributes", "financials", "loan_daily"):
            sub.add_argument(f"--{table}", required=True, help="source CSV")
        if name == "backfill":
            sub.add_argument("--rules", choices=RULES, default="strip_first")
            sub.add_argument("--changed_only", action="store_true", help="only months whose input changed since the last backfill")
    sub = command("silver", span=True)
    sub.add_argument("--rules", choices=RULES, default="strip_first")
    sub.add_argument("--whole", action="store_true", help="replace the whole tables")
    sub = command("gold", span=True)
    sub.add_argument("--dpd", type=int)
    sub.add_argument("--mob", type=int, default=6)
    sub.add_argument("--labelled", action="store_true", help="feature store that carries the labels")
    sub.add_argument("--whole", action="store_true", help="replace the whole tables")

    sub = command("train-monthly")
    sub.add_argument("--train_date", required=True)
    sub.add_argument("--n_iter", type=int, default=100)
    sub.add_argument("--cv_folds", type=int, default=3)
    sub.add_argument("--at_once", type=int, default=16, help="models of the search that grow in one pass")
    sub = command("train")
    sub.add_argument("--recipe", choices=RECIPES, required=True)
    sub.add_argument("--train_date", required=True)
    sub.add_argument("--label_col", default="default")
    sub.add_argument("--sample_frac", type=float, default=0.3)
    sub.add_argument("--n_iter", type=int, default=10)
    sub.add_argument("--cv_folds", type=int, default=5)
    sub.add_argument("--parallelism", type=int, default=2, help="fits of the search at a time")
    sub.add_argument("--at_once", type=int, default=16, help="boosted models of the search that grow in one pass")
    sub.add_argument("--random_state", type=int, default=42)
    for part, months in (("train", 8), ("val", 2), ("test", 2), ("oot", 2)):
        sub.add_argument(f"--{part}_months", type=int, default=months)

    sub = command("score", span=True)
    sub.add_argument("--model_name", required=True)
    sub = command("monitor")
    sub.add_argument("--model_label", required=True)
    sub.add_argument("--snapshotdate", required=True)
    sub.add_argument("--baseline_date", required=True)
    sub.add_argument("--with_labels", action="store_true")
    sub.add_argument("--label_col", default="label")
    sub.add_argument("--psi_warn", type=float, default=drift.PSI_WARN)
    sub.add_argument("--psi_crit", type=float, default=drift.PSI_CRITICAL)
    sub = command("version-tables")
    sub.add_argument("--vacuum", type=int, metavar="KEEP", help="remove what the last KEEP commits do not name")
    sub = command("retrain-check")
    sub.add_argument("--as_of", default=date.today().isoformat())
    return top


def span_of(args) -> stages.Span:
    return stages.Span.of(args.snapshotdate) if args.snapshotdate else stages.Span(args.start, args.end)


def sources_of(spark, args):
    names = ("clickstream", "attributes", "financials", "loan_daily")
    return stages.source_files(spark, {name: getattr(args, name) for name in names})


def tuned_rows(spark: SparkSession, layout: stages.Layout, args):
    """Labelled features of the four windows, sampled evenly within window and class."""
    windows = calendar.four_windows(
        args.train_date, args.train_months, args.val_months, args.test_months, args.oot_months
    )
    store = calendar.tag_windows(tables.read_table(spark, layout.labels), windows)
    normal = labels.normalise_label(store, args.label_col)
    name = labels.label_column(normal, args.label_col)
    binary = normal.withColumn("label", F.col(name).cast("int"))
    stratum = binary.withColumn("stratum", F.concat_ws("|", "split", "label"))
    # a sample to fit on; what the model is judged by stays whole
    fitted_on = stratum.where(F.col("split") == "train")
    sampled = splits.stratified_sample(fitted_on, "stratum", args.sample_frac, args.random_state)
    sampled = sampled.unionByName(stratum.where(F.col("split") != "train")).drop("stratum")
    span = stages.Span(windows[-1].start.isoformat(), windows[0].end.isoformat())
    return windows, modelling.training_set(sampled, span.apply(tables.read_table(spark, layout.features)))


def monthly_rows(spark: SparkSession, layout: stages.Layout, train_date: str):
    oot, train_test = calendar.month_windows(train_date)
    store = tables.read_table(spark, layout.labels)
    held_out = store.where(oot.covers(F.col("snapshot_date"))).withColumn("split", F.lit("oot"))
    shared = splits.stratified_split(store.where(train_test.covers(F.col("snapshot_date"))), KEY)
    span = stages.Span(train_test.start.isoformat(), oot.end.isoformat())
    features = span.apply(tables.read_table(spark, layout.features))
    return [oot, train_test], modelling.training_set(shared.unionByName(held_out), features)


def finish_training(spark, layout, trained, args, windows) -> None:
    version = training.model_version(args.train_date)
    path = layout.model(version if trained.recipe == training.MONTHLY.name else f"{version}_{trained.recipe}")
    training.save(trained, path, args.train_date, windows, spark)
    training.append_runs(training.run_log(trained, args.train_date), layout.runs)
    trained.metrics.show(truncate=False)
    training.top_features(spark, trained).show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark, layout = session(args.stage), stages.Layout(args.root.rstrip("/"))
    if args.stage == "bronze":
        stages.ingest(sources_of(spark, args), layout, span_of(args))
    elif args.stage == "backfill":
        made = stages.backfill(
            spark, sources_of(spark, args), layout, args.start, args.end, RULES[args.rules], force=not args.changed_only
        )
        print("months made:", ", ".join(made) or "none")
    elif args.stage == "silver":
        stages.refine(spark, layout, RULES[args.rules], span_of(args), args.whole)
    elif args.stage == "gold":
        default = labels.CALENDAR_RULE if args.labelled else labels.PAYMENT_RULE
        rule = labels.LabelRule(default.dpd if args.dpd is None else args.dpd, args.mob)
        if args.labelled:
            built = stages.build_labelled_gold(spark, layout, rule, span_of(args))
        else:
            built = stages.build_gold(spark, layout, rule, span_of(args), args.whole)
        print("built" if built else "no data")
    elif args.stage == "train-monthly":
        windows, data = monthly_rows(spark, layout, args.train_date)
        search = training.Search(args.n_iter, args.cv_folds, "balanced_accuracy", seed=42, at_once=args.at_once)
        work = layout.search(f"{training.model_version(args.train_date)}_{training.MONTHLY.name}")
        finish_training(spark, layout, training.train(data, training.MONTHLY, KEY, search=search, work=work), args, windows)
    elif args.stage == "train":
        windows, data = tuned_rows(spark, layout, args)
        search = training.Search(args.n_iter, args.cv_folds, "recall", args.random_state, args.parallelism, args.at_once)
        params = {"gbt": {"maxIter": 100}, "boosted": {"n_estimators": 100}}.get(args.recipe)
        work = layout.search(f"{training.model_version(args.train_date)}_{args.recipe}")
        trained = training.train(data, RECIPES[args.recipe], KEY, params, search, work)
        finish_training(spark, layout, trained, args, windows)
    elif args.stage == "score":
        model, _ = training.load(spark, layout.model(args.model_name.removesuffix(".pkl")))
        store = span_of(args).apply(tables.read_table(spark, layout.features))
        if store.isEmpty():
            print("no features")
        else:
            scores = scoring.predictions(model, store, args.model_name)
            print("rows written:", scoring.write_predictions(scores, layout.predictions))
    elif args.stage == "monitor":
        truth = tables.read_table(spark, layout.labels) if args.with_labels else None
        row = monitoring.report(
            tables.read_table(spark, layout.predictions), args.model_label, args.snapshotdate, args.baseline_date,
            truth, args.label_col, args.psi_warn, args.psi_crit,
        )
        out = layout.monitoring(args.model_label, args.snapshotdate)
        monitoring.write_report(row, out)
        return spark.read.json(f"{out}/monitor_report").select("exit_code").first()[0]
    elif args.stage == "version-tables":
        for path, by in layout.snapshot_tables():
            table = versions.VersionedTable(spark, path, by)
            if versions.is_versioned(spark, path):
                removed = table.vacuum(args.vacuum) if args.vacuum else 0
                print(f"{path}: {len(table.pointers())} partitions, {removed} versions removed")
            elif tables.exists(spark, path):
                table.adopt()
                print(f"{path}: versioned")
    elif args.stage == "retrain-check":
        runs = stages.optional(lambda: tables.read_table(spark, layout.runs))
        needed = True if runs is None else drift.retrain_needed(runs, args.as_of).first()["retrain"]
        print("retrain" if needed else "keep")
        return 0 if needed else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
