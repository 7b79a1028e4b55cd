"""Command line: preprocess, promote a baseline, validate, train, score and profile passenger tables.

    python -m tablewright preprocess --train_input train.csv --test_input test.csv --output_path data --baseline_path base
    python -m tablewright baseline --data_path data --baseline_path base --existing replace
    python -m tablewright validate --data_path data --baseline_path base --status_path status
    python -m tablewright train --data_path data --status_path status --model_out model --report_path reports
    python -m tablewright score --input new.csv --data_path data --model model --output scored
    python -m tablewright profile --input train.csv --output profile
"""

from __future__ import annotations

import argparse

from tablewright import presets, session
from tablewright.operators.clean import cast_numeric
from tablewright.operators.impute import FillModel
from tablewright.operators.profile import numeric_profile, write_profile
from tablewright.plans.preprocess import create_baseline, preprocess, read_split
from tablewright.plans.score import score_raw_all
from tablewright.plans.train import train
from tablewright.plans.validate import decide, validate
from tablewright.sources.models import load_model
from tablewright.sources.runlog import Run
from tablewright.sources.tables import read_csv, read_parquet, write_parquet


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = session.build(args.profile, master=args.master)
    if args.command == "preprocess":
        preprocess(
            read_csv(spark, args.train_input, presets.RAW_SCHEMA),
            read_csv(spark, args.test_input, presets.RAW_TEST_SCHEMA),
            presets.TABLE,
            args.output_path,
            args.baseline_path,
            fit_scope=args.fit_scope,
        )
    elif args.command == "baseline":
        create_baseline(spark, presets.TABLE, args.data_path, args.baseline_path, existing=args.existing)
    elif args.command == "validate":
        validate(
            read_split(spark, args.data_path, "train"),
            read_parquet(spark, args.baseline_path),
            presets.DRIFT_NUMERIC,
            presets.DRIFT_CATEGORICAL,
            args.status_path,
        ).show(truncate=False)
    elif args.command == "train":
        decision = decide(spark, args.status_path, args.model_out).first()
        print(f"{decision['action']}: {decision['reason']}")
        if decision["action"] == "train":
            with Run(spark, f"{args.report_path}/runs", f"training_{args.profile}") as run:
                run.params({**session.profile_settings(args.profile), "experiment_profile": args.profile})
                run.params({"data_path": args.data_path, "model_out": args.model_out})
                run.tags({"framework": "PySpark", "profile": args.profile})
                train(
                    read_split(spark, args.data_path, "train"),
                    presets.TRAINING,
                    args.model_out,
                    args.report_path,
                    run,
                )
    elif args.command == "score":
        fills = FillModel.load(spark, f"{args.data_path}/fills", presets.TABLE.fills)
        found = score_raw_all(
            read_csv(spark, args.input, presets.RAW_TEST_SCHEMA),
            presets.TABLE,
            presets.FEATURES,
            fills,
            load_model(args.model),
            presets.request_rules(required=False),
            presets.POSITIVE_LABEL,
            presets.NEGATIVE_LABEL,
        )
        write_parquet(found, args.output, ["outcome"])
    elif args.command == "profile":
        raw = cast_numeric(read_csv(spark, args.input, presets.RAW_SCHEMA), presets.NUMERIC_RAW)
        write_profile(numeric_profile(raw, presets.PROFILED), args.output)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tablewright", description="Passenger table jobs")
    parser.add_argument("--profile", default=session.DEFAULT_PROFILE, choices=sorted(session.PROFILES))
    parser.add_argument("--master", default=None)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, options in {
        "preprocess": ["train_input", "test_input", "output_path"],
        "baseline": ["data_path", "baseline_path"],
        "validate": ["data_path", "baseline_path", "status_path"],
        "train": ["data_path", "status_path", "model_out", "report_path"],
        "score": ["input", "data_path", "model", "output"],
        "profile": ["input", "output"],
    }.items():
        command = commands.add_parser(name)
        for option in options:
            command.add_argument(f"--{option}", required=True)
        if name == "preprocess":
            command.add_argument("--baseline_path", default=None)
            command.add_argument("--fit_scope", default="combined", choices=["combined", "train"])
        if name == "baseline":
            command.add_argument("--existing", default="error", choices=["error", "keep", "replace"])
    return parser


if __name__ == "__main__":
    main()
