"""python -m quarry list | config [FILE] | run QUERY FOLDER [--rows N] | explain QUERY FOLDER | sql QUERY
| build ROOT --chunks PATH [--registry PATH] [--vectors PATH] [--contexts PATH] [--sources PATH] [--labels PATH] | search ROOT QUESTION... [--rows N] | versions ROOT | collect ROOT [--keep N]

Tables are Parquet, or JSON lines where a path ends in .json or .jsonl; ROOT is the folder of a knowledge base.
"""

from __future__ import annotations

import argparse
import json

from . import config
from .session import get_spark, ship


#: Tables that a build takes beside chunks.
TABLES = ("registry", "vectors", "contexts", "sources", "labels")


def store_command(a: argparse.Namespace) -> int:
    """Build a knowledge base, ask it, or look after its versions."""
    from .plans import knowledge_base as kb
    from .sources.snapshots import Snapshots

    spark = get_spark()
    ship(spark)
    snapshots = Snapshots(spark, a.root)
    if a.command == "build":
        read = lambda path: spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)
        given = {name: read(path) for name in TABLES if (path := getattr(a, name))}
        version = kb.build(spark, a.root, read(a.chunks), **given)
        print(f"version {version.number}: {version.table('chunks').count()} chunks, {', '.join(sorted(version.tables))}")
    elif a.command == "search":
        version = snapshots.version()
        if version is None:
            print("nothing is built there")
            return 1
        questions = spark.createDataFrame(list(enumerate(a.question)), "qid int, query string")
        found = kb.StoredRetriever(version, client=None).sparse(questions, a.rows)
        chunks = version.table("chunks").select("rowid", "source", "chunk", "trail", "text")
        for r in found.join(chunks, "rowid").orderBy("qid", "rank").collect():  # questions x rows
            print(f"{r['qid']}.{r['rank']}\t{r['score']:.5f}\t{r['source']}#{r['chunk']}\t{(r['text'] or '')[:120]!r}")
    elif a.command == "versions":
        for n in snapshots.numbers():
            print(f"{n}\t{', '.join(sorted(snapshots.version(n).tables))}")
    else:
        print("\n".join(snapshots.collect(a.keep)))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarry", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    sub.add_parser("config").add_argument("file", nargs="?")
    for name in ("run", "explain"):
        s = sub.add_parser(name)
        s.add_argument("query")
        s.add_argument("folder")
        s.add_argument("--rows", type=int, default=20)
    sub.add_parser("sql").add_argument("query")
    s = sub.add_parser("build")
    s.add_argument("root")
    s.add_argument("--chunks", required=True)
    for name in TABLES:
        s.add_argument(f"--{name}")
    s = sub.add_parser("search")
    s.add_argument("root")
    s.add_argument("question", nargs="+")
    s.add_argument("--rows", type=int, default=10)
    sub.add_parser("versions").add_argument("root")
    s = sub.add_parser("collect")
    s.add_argument("root")
    s.add_argument("--keep", type=int, default=2)
    a = p.parse_args(argv)
    if a.command in ("build", "search", "versions", "collect"):
        return store_command(a)
    from .plans import index_queries, operators, queries  # noqa: F401
    from .plans.registry import QUERIES, SQL

    if a.command == "list":
        print("\n".join(f"{n}{'' if n in SQL else '  (no SQL)'}" for n in sorted(QUERIES)))
    elif a.command == "config":
        cfg = config.load(a.file)
        print(json.dumps({"hash": config.config_hash(cfg), "changed": config.diff(cfg), "config": cfg}, indent=1))
    elif a.command == "sql":
        print(SQL[a.query])
    else:
        spark = get_spark()
        ship(spark)
        df = QUERIES[a.query](spark, a.folder)
        df.show(a.rows, truncate=80) if a.command == "run" else df.explain("formatted")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
