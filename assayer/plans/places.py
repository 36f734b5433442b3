"""The command line for a batch of points: places from cached lookups, after fetching those that are missing if a service is named.

    python -m assayer.plans.places points.csv places.geojson --reverse-cache DIR --node-cache DIR
        [--user-agent "NAME (CONTACT)" --reverse-url URL --node-url URL]

Exit 0 if every point has a place, 2 if some have none, 1 if nothing was written.
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..functions import scalars as sc
from ..operators import toponyms
from ..sources import lookups
from ..sources import tables as inputs
from .run import resolve_batch


def fetch_missing(points: DataFrame, reverse_cache: str, node_cache: str, service: lookups.Service, reverse_url: str, node_url: str) -> tuple[int, int]:
    """Fill the caches: reverse lookups of all points, then nodes around those whose lookup is no place itself.  How many were made of each."""
    made = lookups.fetch_reverse(points, reverse_cache, service, reverse_url)
    known = inputs.read_reverse_cache(points.sparkSession, Path(reverse_cache).as_uri()).where(~toponyms.is_place_node("osm_type", "category")).select("key").distinct()
    rest = points.withColumn("key", sc.cache_key("latitude", "longitude")).join(known, "key", "left_semi").drop("key")
    return made, lookups.fetch_nodes(rest, node_cache, service, node_url, toponyms.PLACE_KINDS, int(toponyms.RADIUS_M))


def main(argv: list[str] | None = None, service: lookups.Service | None = None) -> int:
    parser = argparse.ArgumentParser(description="Find the places that points belong to")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--reverse-cache", required=True)
    parser.add_argument("--node-cache", required=True)
    parser.add_argument("--user-agent")
    parser.add_argument("--reverse-url")
    parser.add_argument("--node-url")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if args.reverse_url or args.node_url:
            if not (args.reverse_url and args.node_url):
                raise ValueError("name both services or none")
            points = inputs.read_points(spark, Path(args.input).resolve().as_uri())
            outside = [r["id"] for r in toponyms.out_of_range(points).limit(10).collect()]
            if outside:
                raise ValueError("points without usable coordinates, nothing was asked: " + ", ".join(outside))
            fetch_missing(points, args.reverse_cache, args.node_cache, service or lookups.Service(args.user_agent or ""), args.reverse_url, args.node_url)
        counts = resolve_batch(spark, Path(args.input).resolve().as_uri(), Path(args.reverse_cache).resolve().as_uri(), Path(args.node_cache).resolve().as_uri(), args.output)
    except (ValueError, RuntimeError, OSError) as e:
        print(f"Error: {e}")
        return 1
    print("\n".join([f"{sum(counts.values())} points: {args.output}", *(f"  {status:<13} {n}" for status, n in counts.items())]))
    return 2 if counts.get("unresolved") else 0


if __name__ == "__main__":
    raise SystemExit(main())
