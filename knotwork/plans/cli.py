"""Command line: import a folder, clear a graph or a domain of it, move concepts to typed nodes."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from knotwork.functions import vocabulary
from knotwork.operators import graph
from knotwork.plans.imports import import_documents
from knotwork.plans.settings import Settings, env_file
from knotwork.sources.markdown_files import read_markdown
from knotwork.sources.versions import exists

#: Folders looked for where none is named.
FOLDERS = ["./knowledge", "./domain_1"]


def default_folder() -> str:
    return next((f for f in FOLDERS if os.path.isdir(f)), FOLDERS[0])


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="knotwork")
    out.add_argument("--graph", required=True, help="folder of the graph")
    sub = out.add_subparsers(dest="command", required=True)
    add = sub.add_parser("import")
    add.add_argument("folder", nargs="?", default=None)
    add.add_argument("--clear", action="store_true", help="begin with an empty graph")
    clear = sub.add_parser("clear")
    clear.add_argument("--domain")
    clear.add_argument("--confirm", action="store_true", help="do not ask")
    move = sub.add_parser("migrate")
    move.add_argument("--dry-run", action="store_true")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("knotwork").getOrCreate()
    if args.command == "import":
        folder = args.folder or default_folder()
        if not exists(spark, folder):
            print(f"no folder {folder}", file=sys.stderr)
            return 1
        got = import_documents(read_markdown(spark, folder), Settings.from_env(environ={**env_file(), **os.environ}))
        nodes, edges = got.nodes, got.edges
        if not args.clear:
            old_nodes, old_edges = graph.read_graph(spark, args.graph)
            nodes = graph.merge_nodes(old_nodes.withColumn("seq", F.lit(0).cast("long")).unionByName(nodes.withColumn("seq", F.lit(1).cast("long"))))
            edges = graph.merge_edges(old_edges.unionByName(edges).dropDuplicates(["src_id", "dst_id", "rel_type"]).withColumn("seq", F.lit(0).cast("long")))
        graph.write_graph(nodes, edges, args.graph)
        print(", ".join(f"{k} {n}" for k, n in got.stats.items()))
        return 0
    nodes, edges = graph.read_graph(spark, args.graph)
    if args.command == "clear":
        if not args.confirm and input("clear? [y/N] ").strip().lower() != "y":
            return 1
        if args.domain:
            counts, nodes, edges = graph.clear_domain(nodes, edges, args.domain)
            print(counts.first().asDict())
        else:
            print(graph.graph_counts(nodes, edges).first().asDict())
            nodes, edges = graph.clear_all(spark)
        graph.write_graph(nodes, edges, args.graph)
        return 0
    moved, nodes, edges = graph.migrate_concepts(nodes, edges, vocabulary.registry_table(spark))
    print(f"{moved.count()} concepts")
    if args.dry_run:
        for r in moved.orderBy("name").limit(10).collect():
            print(f"{r['name']} -> {r['entity_type']} {r['canonical']}")
    else:
        graph.write_graph(nodes, edges, args.graph)
    return 0


if __name__ == "__main__":
    sys.exit(main())
