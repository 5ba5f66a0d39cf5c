"""Command line: python -m understory.cli POINTS OUTPUT [options]."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import fields

from understory.params import DEFAULT_DIMENSIONS, Parameters, check_aoi, check_input, split_names


FLAGS = {"performance_report": "write phase timings and parameters", "keep_ground_classes": "build the terrain from the points of class 2 instead of classifying"}


def parser() -> argparse.ArgumentParser:
    """Options by the names of parameters, with dashes or underscores."""
    out = argparse.ArgumentParser(prog="understory", description="Forest structure of a point cloud by tiles and segments.")
    out.add_argument("--point-cloud", "--point_cloud", required=True, help="points: .las, .parquet or .csv")
    out.add_argument("--output-dir", "--output_dir", required=True, help="existing folder for the artifacts")
    out.add_argument("--aoi", help="footprint: .geojson, .json or .gpkg; the cloud's extent without it")
    out.add_argument("--epsg", type=int, help="coordinate system written to rasters and tiles")
    out.add_argument("--instance-dimension", "--instance_dimension", action="append", help=f"segment-id attributes, repeatable or comma-separated (default: {', '.join(DEFAULT_DIMENSIONS)})")
    out.add_argument("--segment-diagnostics", "--segment_diagnostics", action="store_true", help="accepted for compatibility; the table is always written")
    for f in fields(Parameters):
        if f.name in ("instance_dimensions",):
            continue
        names = dict.fromkeys((f"--{f.name.replace('_', '-')}", f"--{f.name}"))
        if f.name in FLAGS:
            out.add_argument(*names, action="store_true", help=FLAGS[f.name])
        elif f.name == "dataset_id":
            out.add_argument(*names, type=int, required=True, help="number that artifacts are named by")
        else:
            out.add_argument(*names, type=type(f.default), default=f.default, help=f"(default: {f.default:g})")
    return out


def parse(argv: list[str] | None = None) -> tuple[argparse.Namespace, Parameters]:
    args = parser().parse_args(argv)
    named = split_names(",".join(args.instance_dimension)) if args.instance_dimension else DEFAULT_DIMENSIONS
    values = {f.name: getattr(args, f.name) for f in fields(Parameters) if f.name != "instance_dimensions"}
    p = Parameters(**values, instance_dimensions=named)
    check_input(args.point_cloud)
    if args.aoi:
        check_aoi(args.aoi)
    return args, p


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    try:
        args, p = parse(argv)
        from pyspark.sql import SparkSession

        from understory.plans.run import run

        spark = SparkSession.builder.appName("understory").master(f"local[{p.threads or '*'}]").getOrCreate()
        found = run(spark, args.point_cloud, args.output_dir, p, args.aoi, epsg=args.epsg)
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    print(f"{found['tiles']} tiles, {len(found['paths'])} files")
    return 0


if __name__ == "__main__":
    sys.exit(main())
