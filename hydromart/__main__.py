"""Daily run: ``python -m hydromart --raw-obs ... --out ... [--model ... --model-sha256 ...]``.

Optionally loads landed river pages and weather documents into the raw tables first (both or
neither), builds the dimensions and marts with their quality gates, optionally trains a model, then
(when a model is given) scores the latest feature date and merges the predictions. The session
comes from ``spark-submit``/the cluster; only unset settings are filled in.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from hydromart.plans import pipeline
from hydromart.session import build_session
from hydromart.sources import readers


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="hydromart", description=__doc__.splitlines()[0])
    ap.add_argument("--raw-obs", required=True)
    ap.add_argument("--raw-stations", required=True)
    ap.add_argument("--raw-weather", required=True)
    ap.add_argument("--weather-history", required=True)
    ap.add_argument("--communes-csv", required=True)
    ap.add_argument("--out", required=True, help="folder of the marts and predictions")
    ap.add_argument("--cutover", default=pipeline.staging.WEATHER_CUTOVER)
    ap.add_argument("--model", help="saved PipelineModel to score with")
    ap.add_argument("--model-sha256", help="expected fingerprint of the saved model")
    ap.add_argument("--profile", default="cluster", choices=["local", "cluster"])
    ap.add_argument("--landed-river-pages", help="landed API pages to load into --raw-obs first")
    ap.add_argument("--landed-weather", help="landed weather documents to load into --raw-weather first")
    ap.add_argument("--batch-id", help="batch id of these loads (default: UTC timestamp)")
    ap.add_argument("--risk-frequency", help="raw flood-risk frequency table")
    ap.add_argument("--risk-coverage", help="raw flood-risk coverage table")
    ap.add_argument("--train-to", help="fit a model on the feature mart and save it here")
    ap.add_argument("--train-cutoff", default=pipeline.ml.SPLIT_DATE)
    a = ap.parse_args(argv)
    spark = build_session(profile=a.profile)
    paths = pipeline.Paths(a.raw_obs, a.raw_stations, a.raw_weather, a.weather_history, a.communes_csv, a.out,
                           a.risk_frequency, a.risk_coverage)
    result = {}
    if a.landed_river_pages or a.landed_weather:
        batch = a.batch_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
        requested = readers.read_communes_csv(spark, a.communes_csv).where("code_INSEE IS NOT NULL")
        result["ingest"] = pipeline.daily_loads(spark, paths, batch, a.landed_river_pages, a.landed_weather, requested)
    result["marts"] = pipeline.build_marts(spark, paths, cutover=a.cutover)
    if a.train_to:
        result["model_sha256"] = pipeline.train(spark, paths, a.train_to, a.train_cutoff)
    if a.model:
        result["predictions_written"] = pipeline.score(spark, paths, a.model, a.model_sha256)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
