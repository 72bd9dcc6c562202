"""Jobs for ``spark-submit``: ``python -m skyloom <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from skyloom.operators.dataset import SPLIT_DATE
from skyloom.operators.model import load_model, score
from skyloom.plans.features import FeatureOutputs, run_feature_job
from skyloom.plans.scoring import score_from_store
from skyloom.plans.training import run_joined_training, run_raw_training
from skyloom.schemas import AIRPORT_GROUP, FLIGHT_GROUP
from skyloom.session import build_session
from skyloom.sources.archives import extract_lines, scan_archives, write_extracted
from skyloom.sources.store import FeatureStore
from skyloom.streaming.jobs import start_feature_stream


_WINDOWS = {"size": "4 hours", "slide": "1 hour", "feature-time": "window_start"}
_EVALUATION = {"limit": None, "order": "", "buckets": None}


def _listed(names: str | None) -> list[str]:
    """The names of a comma-separated list."""
    return [n.strip() for n in (names or "").split(",") if n.strip()]


def _evaluation(args) -> dict:
    """The test rows that are evaluated, the first ``limit`` in ``order``, and the buckets of the curve."""
    if args.limit and not _listed(args.order):
        raise ValueError("--limit needs --order, the columns that say which rows come first")
    return {
        "limit": int(args.limit) if args.limit else None,
        "order": _listed(args.order),
        "buckets": int(args.buckets) if args.buckets else None,
    }


def _windows(args) -> dict:
    return {"size": args.size, "slide": args.slide, "feature_time": args.feature_time}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyloom")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, help, *options, **defaults):
        sub = jobs.add_parser(name, help=help)
        for option in options:
            sub.add_argument(f"--{option}", required=option not in defaults, default=defaults.get(option))

    job("extract", "unzip monthly archives", "input", "output")
    job(
        "features",
        "raw files to airport features, flights and read instances",
        *["input", "output-airports", "output-flights", "output-read-instances", "output-rejects"],
        *["format", "size", "slide", "feature-time"],
        **{"output-rejects": None, "format": "parquet", **_WINDOWS},
    )
    job(
        "stream-features",
        "the same for files as they arrive, until stopped; --available-now yes drains what is there",
        *["input", "output-airports", "output-flights", "output-read-instances", "output-rejects", "checkpoint"],
        *["output-open-airports", "available-now", "delay", "max-files", "size", "slide", "feature-time"],
        **{"output-read-instances": "", "output-rejects": "", "output-open-airports": ""},
        **{"available-now": "no", "delay": "1 hour", "max-files": 0, **_WINDOWS},
    )
    job("setup-store", "declare the feature groups", "store")
    job(
        "ingest",
        "load feature files into the store; feature lists name the columns written, a sequence column decides between versions",
        *["store", "flights", "airports", "format", "flight-features", "airport-features", "sequence"],
        **{"flights": None, "airports": None, "format": "parquet"},
        **{"flight-features": None, "airport-features": None, "sequence": None},
    )
    job(
        "train-raw",
        "train and evaluate on raw files",
        *["training-data", "test-split-date", "output", "limit", "order", "buckets"],
        **{"test-split-date": SPLIT_DATE, **_EVALUATION},
    )
    job(
        "train-joined",
        "train and evaluate on the feature store",
        *["store", "read-instances", "test-split-date", "output", "exact", "bucket", "max-age", "limit", "order", "buckets"],
        **{"test-split-date": SPLIT_DATE, "exact": "", "bucket": "1 day", "max-age": None, **_EVALUATION},
    )
    job(
        "score",
        "score request rows, enriched from the store if one is named",
        *["requests", "model", "output", "store"],
        store=None,
    )
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"skyloom-{args.job}")
    if args.job == "extract":
        write_extracted(extract_lines(scan_archives(spark, args.input)), args.output)
    elif args.job == "features":
        outputs = FeatureOutputs(
            args.output_airports,
            args.output_flights,
            args.output_read_instances,
            args.output_rejects,
        )
        run_feature_job(spark, args.input, outputs, args.format, **_windows(args))
    elif args.job == "stream-features":
        outputs = FeatureOutputs(
            args.output_airports, args.output_flights, args.output_read_instances,
            args.output_rejects or None, args.output_open_airports or None,
        )
        drained = args.available_now == "yes"
        start_feature_stream(
            spark, args.input, outputs, args.checkpoint,
            delay=args.delay, max_files=int(args.max_files) or None, available_now=drained,
            **_windows(args),
        )
        if not drained:
            spark.streams.awaitAnyTermination()
    elif args.job == "setup-store":
        store = FeatureStore(spark, args.store)
        store.create(FLIGHT_GROUP)
        store.create(AIRPORT_GROUP)
    elif args.job == "ingest":
        store = FeatureStore(spark, args.store)
        for group, path, names, entity in (
            (FLIGHT_GROUP, args.flights, args.flight_features, "flight_number"),
            (AIRPORT_GROUP, args.airports, args.airport_features, "origin_airport_id"),
        ):
            if path:
                store.ingest_files(
                    group, path, entity_id=entity, feature_time="timestamp", fmt=args.format,
                    feature_ids=_listed(names) or None, sequence=args.sequence,
                )
    elif args.job == "train-raw":
        run_raw_training(
            spark, args.training_data, args.test_split_date, output=args.output, **_evaluation(args)
        )
    elif args.job == "train-joined":
        store = FeatureStore(spark, args.store)
        run_joined_training(
            store, args.read_instances, args.test_split_date, output=args.output,
            exact=tuple(_listed(args.exact)), bucket=args.bucket, max_age=args.max_age, **_evaluation(args),
        )
    elif args.job == "score":
        model = load_model(args.model)
        requests = spark.read.parquet(args.requests)
        if args.store:
            requests = requests.withColumn("airport_id", F.col("airport_id").cast("string"))
            scored = score_from_store(requests, FeatureStore(spark, args.store), model)
        else:
            scored = score(requests, model)
        scored.write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
