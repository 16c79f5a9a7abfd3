"""Time the headline jobs on the trade graph and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.operators import graph_from_edges, neighbours, pagerank, peer_pressure
from vertexloom.plans import cluster_files, rank_and_cluster
from vertexloom.plans import table_graphs as tables
from vertexloom.runtime import scratch_path, use_local_scratch
from vertexloom.sources import (
    infer_schema,
    load_graph,
    read_edges_csv,
    read_edges_dir,
    read_graphson,
    save_graph,
    staged_graphson,
    write_graphson,
    write_schema,
    write_vertices_csv,
    write_vertices_dir,
)


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vertexloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_scratch(spark)
    seconds: dict[str, float] = {}

    def timed(name: str, job):
        started = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{seconds[name]:8.2f} {name}", file=sys.stderr, flush=True)
        return result

    # inputs of the jobs below, not timed
    edges = tables.trade(spark, folder)
    header_csv, csv_dir, root, work = (scratch_path(spark, what) for what in ("csv", "dir", "store", "work"))
    edges.write.option("header", True).csv(header_csv)
    edges.write.csv(f"{csv_dir}/data.csv")
    write_schema(spark, csv_dir, infer_schema(edges))

    def load_header_csv():
        graph = graph_from_edges(
            read_edges_csv(spark, header_csv, "src", "dst", "weight"), directed=True, name="trade"
        )
        return save_graph(graph, root, "trade", endpoints_only=True)

    def load_dir_undirected():
        graph = graph_from_edges(
            read_edges_dir(spark, csv_dir, "src", "dst", ["weight"]), directed=False, name="both"
        )
        return save_graph(graph, root, "both", endpoints_only=True)

    timed("load_header_csv", load_header_csv)
    timed("load_dir_undirected", load_dir_undirected)
    graph, both = load_graph(spark, root, "trade"), load_graph(spark, root, "both")

    # the first run of a plan compiles it
    pagerank(both, max_iter=2)
    peer_pressure(both, max_iter=2)

    timed("pagerank_5", lambda: pagerank(graph, max_iter=5))
    ranking = timed("pagerank_20", lambda: pagerank(graph, max_iter=20))
    timed("pagerank_undirected_20", lambda: pagerank(both, max_iter=20))
    timed("peer_pressure_unit_5", lambda: peer_pressure(both, max_iter=5))
    rounds = timed("peer_pressure_unit_30", lambda: peer_pressure(both, max_iter=30))
    timed("peer_pressure_distributed_5", lambda: peer_pressure(both, vote="distributed", max_iter=5))
    timed("neighbours", lambda: run(neighbours(graph)))
    timed("graphson_write", lambda: write_graphson(graph, f"{work}/graphson"))
    read = timed("graphson_read", lambda: read_graphson(spark, f"{work}/graphson"))
    timed("graphson_read_edges", lambda: run(read.edges))
    timed("export_csv", lambda: write_vertices_csv(ranking.graph, f"{work}/csv", ["pagerank"]))
    timed("export_dir", lambda: write_vertices_dir(ranking.graph, f"{work}/dir", ["pagerank"]))
    # the total is over the jobs so far, which earlier runs had too
    total = round(sum(seconds.values()), 3)

    def whole_graphson():
        with staged_graphson(spark, f"{work}/graphson") as whole:
            run(whole.vertices)
            run(whole.edges)

    def append():
        few = spark.createDataFrame([(f"new{i}", f"s{i}", 1.0) for i in range(1, 1001)], "src string, dst string, weight double")
        return save_graph(graph_from_edges(few, directed=True, name="trade"), root, "trade", overwrite=False)

    quoted = scratch_path(spark, "csv")
    broken = edges.withColumn("src", F.concat("src", F.lit('\n"x"')))
    broken.coalesce(1).write.option("header", True).option("escape", '"').csv(quoted)
    timed("graphson_read_all", whole_graphson)
    timed("append_1000_edges", append)
    timed("read_quoted_breaks", lambda: run(read_edges_csv(spark, quoted, "src", "dst", "weight", multiline=True)))
    chain = {"src": "src", "dst": "dst", "directed": True}
    timed(
        "rank_and_cluster",
        lambda: rank_and_cluster(
            spark, header_csv, root, "chain", f"{work}/chain", weight="weight", max_iter=5, cluster_iter=5, **chain
        ),
    )
    timed(
        "cluster_files",
        lambda: cluster_files(
            spark, csv_dir, f"{work}/files", f"{work}/clusters", properties=["weight"], max_iter=5, **chain
        ),
    )

    print(
        json.dumps(
            {
                "metric": "total seconds of the property-graph jobs on the trade graph",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "seconds_per_pagerank_iteration": round(
                    (seconds["pagerank_20"] - seconds["pagerank_5"]) / 15, 3
                ),
                "peer_pressure_unit_30_rounds": rounds.iterations,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
