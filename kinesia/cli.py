"""Command line for the three jobs, for ``spark-submit`` or ``python -m kinesia.cli``.

    kinesia.cli preprocess --input raw/*.csv --output buckets/ [--imu-freq 100 --hr-freq 9] [--console] [--no-sort] [--fast-magnitudes]
                           [--fill [--max-age 10]]
    kinesia.cli train --input buckets/ --output model/ [--seed 1 --max-iter 200] [--tree --max-depth 4] [--without-outliers] [--pruned]
    kinesia.cli stream --input landing/ --checkpoint ckpt/ [--model model/model | --buckets] [--watermark "2 hours"] [--output out/]
                       [--output-mode append] [--max-files-per-trigger 1] [--timeout-ms 0]
    kinesia.cli tables --input landing/ --output tables/ --lateness 7200 [--merged buckets/]

Flags mirror the reference's per-job settings (input/output paths, sampling
rates, console switch, output mode, files per trigger). The session comes from
``SparkSession.builder.getOrCreate()``, so ``spark-submit --conf`` settings apply.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kinesia.ml.evaluate import accuracy_frame
from kinesia.plans.jobs import bucket_tables_job, preprocess_job, stream_job, train_job, tree_job
from kinesia.schema import FEATURES, HR_FREQ_HZ, IMU_FREQ_HZ, LABEL
from kinesia.session import apply_defaults
from kinesia.sinks.files import write_outputs


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="kinesia")
    jobs = parser.add_subparsers(dest="job", required=True)

    pre = jobs.add_parser("preprocess", help="raw CSV -> bucket means (Parquet)")
    pre.add_argument("--input", required=True)
    pre.add_argument("--output")
    pre.add_argument("--imu-freq", type=float, default=IMU_FREQ_HZ)
    pre.add_argument("--hr-freq", type=float, default=HR_FREQ_HZ)
    pre.add_argument("--bucket-ticks", type=int, help="bucket width in 0.01 s ticks (overrides the rates)")
    pre.add_argument("--console", action="store_true", help="show the result instead of writing it")
    pre.add_argument(
        "--fast-magnitudes", action="store_true",
        help="square in double instead of exact decimals (~4x cheaper per row, within 1e-10)",
    )
    pre.add_argument(
        "--no-sort", action="store_true",
        help="skip the global sort by time (a full shuffle of the output; training does not need it)",
    )

    pre.add_argument("--fill", action="store_true", help="fill missing readings forward instead of taking bucket means")
    pre.add_argument("--max-age", type=float, default=None, help="with --fill: seconds after which a reading is too old")

    tr = jobs.add_parser("train", help="bucket means -> model, scaler, hold-out predictions")
    tr.add_argument("--input", required=True)
    tr.add_argument("--output", required=True)
    tr.add_argument("--features", nargs="+", default=list(FEATURES))
    tr.add_argument("--label", default=LABEL)
    tr.add_argument("--seed", type=int, default=1)
    tr.add_argument("--max-iter", type=int, default=200)
    tr.add_argument("--single-file-results", action="store_true")
    tr.add_argument("--tree", action="store_true", help="a decision tree instead of the network")
    tr.add_argument("--max-depth", type=int, default=4, help="with --tree")
    tr.add_argument("--without-outliers", action="store_true", help="drop rows unlike the signature of their label")
    tr.add_argument("--pruned", action="store_true", help="drop features without a trend, and all but one of features that are alike")

    st = jobs.add_parser("stream", help="landing folder -> (scored) buckets -> console or Kafka")
    st.add_argument("--input", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--model")
    st.add_argument("--output-mode", default=None)
    st.add_argument("--max-files-per-trigger", type=int, default=None)
    st.add_argument("--timeout-ms", type=int, default=0)
    st.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    st.add_argument("--bucket-ticks", type=int, default=None, help="bucket width the model was trained on")
    st.add_argument("--watermark", default=None, help="lateness beyond which readings are dropped (needed for buckets)")
    st.add_argument("--buckets", action="store_true", help="bucket means without a model")
    st.add_argument("--output", help="Parquet output folder (instead of the console)")
    st.add_argument("--imu-freq", type=float, default=IMU_FREQ_HZ)
    st.add_argument("--hr-freq", type=float, default=HR_FREQ_HZ)
    st.add_argument("--kafka-servers")
    st.add_argument("--kafka-topic")

    tb = jobs.add_parser("tables", help="landing folder -> closed buckets, late readings and their merged means")
    tb.add_argument("--input", required=True)
    tb.add_argument("--output", required=True)
    tb.add_argument("--lateness", type=float, required=True, help="seconds a reading may come late to its bucket")
    tb.add_argument("--merged", help="write the means of all that has landed to this folder")
    tb.add_argument("--bucket-ticks", type=int, default=None)
    tb.add_argument("--max-files-per-trigger", type=int, default=None)
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"kinesia-{args.job}").getOrCreate()
    apply_defaults(spark)
    if args.job == "preprocess":
        if not args.console and not args.output:
            raise SystemExit("preprocess needs --output or --console")
        if args.fill:
            preprocess_job(
                spark, args.input, args.output, console=args.console, fill=True, max_age=args.max_age,
                exact_magnitudes=not args.fast_magnitudes,
            )
            return {"job": "preprocess", "output": args.output}
        preprocess_job(
            spark, args.input, args.output, console=args.console, bucket_ticks=args.bucket_ticks,
            imu_freq_hz=args.imu_freq, hr_freq_hz=args.hr_freq, ordered=not args.no_sort,
            exact_magnitudes=not args.fast_magnitudes,
        )
        return {"job": "preprocess", "output": args.output}
    if args.job == "train":
        chosen = {"features": args.features, "label": args.label, "without_outliers": args.without_outliers, "pruned": args.pruned}
        if args.tree:
            tree, scored = tree_job(spark, args.input, args.output, max_depth=args.max_depth, **chosen)
            hits = accuracy_frame(scored.withColumn("hit", F.col(args.label) == F.col("predictedLabel")).withColumn("one", F.lit(1)), "hit", "one")
            summary = {"job": "train", "rules": tree.rules(), "accuracy": hits.first()["accuracy"]}
            print(json.dumps(summary))
            return summary
        result = train_job(
            spark, args.input, args.output, seed=args.seed, max_iter=args.max_iter,
            single_file_results=args.single_file_results, **chosen,
        )
        summary = {"job": "train", "labels": result.labels, "accuracy": result.accuracy()}
        print(json.dumps(summary))
        return summary
    if args.job == "tables":
        tables = bucket_tables_job(
            spark, args.input, args.output, lateness_seconds=args.lateness, bucket_ticks=args.bucket_ticks,
            max_files_per_trigger=args.max_files_per_trigger,
        )
        if args.merged:
            write_outputs([tables.merged()], [args.merged])
        return {"job": "tables", "output": args.output, "late": tables.late().count()}
    options = {"timeout_ms": args.timeout_ms, "available_now": args.available_now}
    if args.output_mode:
        options["output_mode"] = args.output_mode
    if args.kafka_servers:
        options["sink"] = "kafka"
        options["kafka"] = {"servers": args.kafka_servers, "topic": args.kafka_topic}
    if args.output:
        options["sink"], options["paths"] = "files", [args.output]
    queries = stream_job(
        spark, args.input, args.checkpoint, model_path=args.model, buckets=args.buckets, imu_freq_hz=args.imu_freq, hr_freq_hz=args.hr_freq,
        max_files_per_trigger=args.max_files_per_trigger, bucket_ticks=args.bucket_ticks, watermark=args.watermark, **options,
    )
    return {"job": "stream", "queries": [q.id for q in queries]}


if __name__ == "__main__":
    main()
