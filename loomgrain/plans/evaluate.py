"""Evaluation over tables of model outputs."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame

from loomgrain.operators.metrics import answer_metrics, weighted_perplexity


def evaluate(rows: DataFrame, stage: str, probe: int | None = None) -> dict[str, float]:
    """dapt: loss and perplexity of (loss, n_tokens); sft: those with exact match and F1, of the first probe rows by pos."""
    if stage == "dapt":
        r = weighted_perplexity(rows).first()
    elif stage == "sft":
        r = answer_metrics(rows if probe is None else rows.orderBy("pos").limit(probe)).first()
    else:
        raise ValueError(f"unknown stage {stage}")
    return {k: round(float(v), 4) for k, v in r.asDict().items()}


def main(argv: list[str] | None = None) -> None:
    from loomgrain.plans.config import infer_stage, load_stage_config
    from loomgrain.session import build_session

    p = argparse.ArgumentParser(description="Metrics of a stage from a table of model outputs.")
    p.add_argument("--config", required=True)
    p.add_argument("--rows", required=True, help="Parquet with loss and n_tokens; for sft also prediction, reference and pos")
    p.add_argument("--stage", choices=["dapt", "sft"])
    p.add_argument("--probe", type=int)
    a = p.parse_args(argv)
    stage = a.stage or infer_stage(load_stage_config(a.config))
    print(json.dumps(evaluate(build_session("evaluate").read.parquet(a.rows), stage, a.probe)))


if __name__ == "__main__":
    main()
