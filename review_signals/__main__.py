"""Command line: ``python -m review_signals <job> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse

from review_signals.config import SERVING_THRESHOLD, ForestSettings, LabelRules
from review_signals.operators import model as M
from review_signals.plans import jobs
from review_signals.session import build_session
from review_signals.sources.messages import file_stream, kafka_stream
from review_signals.sources.tables import read_table, write_plain
from review_signals.streaming.scoring import await_any


PREVIEW_ROWS = 50


def _show(frames, out: str | None = None) -> None:
    """Print the first rows of each result; with ``out`` every result is also written there as a whole."""
    for name, frame in frames.items() if isinstance(frames, dict) else {"result": frames}.items():
        if out:
            write_plain(frame, f"{out}/{name}")
            frame = read_table(frame.sparkSession, f"{out}/{name}")
        print(f"== {name}")
        frame.show(PREVIEW_ROWS, truncate=False)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="review_signals", description=__doc__)
    commands = root.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, help: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=help)
        for path in paths:
            command.add_argument(path)
        return command

    job("inspect", "raw", help="profile raw files").add_argument("--out", help="write the results as tables here")
    for name, help in (("curate", "raw files to the curated table"), ("profile", "descriptive queries")):
        command = job(name, *(("raw", "out") if name == "curate" else ("curated",)), help=help)
        command.add_argument("--categories", nargs="+", default=list(jobs.C.DEFAULT_CATEGORIES))
        if name == "profile":
            command.add_argument("--out", help="write the results as tables here")
    job("label", "curated", "out", help="weak-supervision labels").add_argument(
        "--burst", type=int, default=LabelRules().burst_reviews
    )
    job("split", "labeled", "train", "test", help="train and test tables by reviewer")
    command = job("lookups", "train", "reviewers", "products", help="history tables")
    command.add_argument("--buckets", type=int)
    command.add_argument("--reviewers-table", help="name of the bucketed table")
    command.add_argument("--products-table", help="name of the bucketed table")
    command = job("features", "labeled", "out", help="feature table")
    command.add_argument("--reviewers")
    command.add_argument("--products")
    command = job("train", "features", "model", help="fit, save and evaluate a forest")
    command.add_argument("--feature-set", choices=sorted(M.FEATURE_SETS), default="full")
    command.add_argument("--trees", type=int, default=ForestSettings().trees)
    command.add_argument("--threshold", type=float)
    command.add_argument("--test-features")
    command.add_argument("--report")
    command = job("compare", "features", "models", help="metrics of the full and the controlled model")
    command.add_argument("--trees", type=int, default=ForestSettings().trees)
    command.add_argument("--test-features")
    command = job("publish", "test", help="send reviews as messages")
    command.add_argument("--path")
    command.add_argument("--servers")
    command.add_argument("--topic")
    command = job("score", "model", "sink", help="score a stream of messages")
    for name in ("reviewers", "products"):
        either = command.add_mutually_exclusive_group(required=True)
        either.add_argument(f"--{name}", help="lookup by path")
        either.add_argument(f"--{name}-table", help="lookup by table name, which keeps its buckets")
    command.add_argument("--threshold", type=float, default=SERVING_THRESHOLD)
    command.add_argument("--interval", default="5 seconds", help="trigger interval; 'once' works off what is there")
    command.add_argument("--starting-offsets", default="latest")
    command.add_argument("--max-per-trigger", type=int, default=1_000_000, help="messages of a topic per trigger")
    command.add_argument("--max-files-per-trigger", type=int, default=1_000)
    command.add_argument("--path")
    command.add_argument("--servers")
    command.add_argument("--topic")
    command.add_argument("--checkpoints")
    command.add_argument("--dead-letters")
    command = job("alerts", "sink", help="alerts over the predictions")
    command.add_argument("--out")
    command.add_argument("--checkpoints")
    command.add_argument("--interval", default="10 seconds")
    command = job("console", "sink", help="show predictions as they come")
    command.add_argument("--checkpoints")
    command.add_argument("--interval", default="5 seconds")
    job("monitor", "sink", help="questions over the predictions").add_argument("--out", help="write the results as tables here")
    return root


def run(spark, a: argparse.Namespace) -> None:
    if a.job == "inspect":
        _show(jobs.inspect(spark, a.raw), a.out)
    elif a.job == "curate":
        _show(jobs.build_curated(spark, a.raw, a.out, a.categories))
    elif a.job == "profile":
        _show(jobs.profile_curated(spark, a.curated, a.categories), a.out)
    elif a.job == "label":
        _show(jobs.build_labels(spark, a.curated, a.out, LabelRules(burst_reviews=a.burst)))
    elif a.job == "split":
        _show(jobs.build_split(spark, a.labeled, a.train, a.test))
    elif a.job == "lookups":
        tables = (a.reviewers_table, a.products_table) if a.reviewers_table and a.products_table else None
        jobs.build_lookups(spark, a.train, a.reviewers, a.products, a.buckets, tables)
    elif a.job == "features":
        jobs.build_features(spark, a.labeled, a.out, a.reviewers, a.products)
    elif a.job == "train":
        settings = ForestSettings(trees=a.trees, threshold=a.threshold)
        metrics, text = jobs.train_model(spark, a.features, a.model, a.feature_set, settings,
                                         a.test_features)
        _show(metrics)
        if a.report:
            with open(a.report, "w", encoding="utf-8") as file:
                file.write(text)
    elif a.job == "compare":
        settings = ForestSettings(trees=a.trees)
        _show(jobs.compare_models(spark, a.features, a.models, settings=settings, test_features=a.test_features))
    elif a.job == "publish":
        jobs.publish(spark, a.test, a.servers, a.topic, a.path)
    elif a.job == "score":
        if a.path:
            incoming = file_stream(spark, a.path, a.max_files_per_trigger)
        else:
            incoming = kafka_stream(spark, a.servers, a.topic, a.starting_offsets, a.max_per_trigger)
        lookups = [
            spark.table(name) if name else read_table(spark, path)
            for name, path in ((a.reviewers_table, a.reviewers), (a.products_table, a.products))
        ]
        running = jobs.run_scoring(incoming, *lookups, a.model, a.sink, a.checkpoints, _interval(a), a.threshold, a.dead_letters)
        _wait(spark, a, running)
    elif a.job == "alerts":
        _wait(spark, a, [jobs.run_alerts(spark, a.sink, a.out, a.checkpoints, _interval(a))])
    elif a.job == "console":
        _wait(spark, a, [jobs.run_review_console(spark, a.sink, a.checkpoints, _interval(a))])
    elif a.job == "monitor":
        _show(jobs.monitor(spark, a.sink), a.out)


def _interval(a: argparse.Namespace) -> str | None:
    return None if a.interval == "once" else a.interval


def _wait(spark, a: argparse.Namespace, running) -> None:
    """Run until a query ends; queries that work off what is there all come to their end."""
    if _interval(a):
        await_any(spark)
    for query in running:
        query.awaitTermination()
        if query.exception():
            raise query.exception()


def main(arguments: list[str] | None = None) -> None:
    parsed = parser().parse_args(arguments)
    run(build_session(f"review-signals-{parsed.job}"), parsed)


if __name__ == "__main__":
    main()
