"""Command line: starter files, pending ids, status, the resolver's queue, and running a registered query.

    python -m framequarry.cli init FOLDER
    python -m framequarry.cli pending URLS --ledger FILE --ledger FILE --out FOLDER
    python -m framequarry.cli status MARKERS --expected N
    python -m framequarry.cli resolve URLS LOG --ledger FILE --model NAME --batch N
    python -m framequarry.cli take URLS LOG --worker NAME --most N
    python -m framequarry.cli ls LOG
    python -m framequarry.cli run QUERY TABLES --out FOLDER
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import functions as F

DEFAULTS = {"keep_interval": 2.0, "cand_fps": 5.0, "conf": 0.2, "batch": 24, "high_water": 50, "retry_after_hours": 6.0, "shards": 6, "scratch": ""}


def starter(folder: str) -> None:
    """A config with all defaults and an empty id list; existing files stay."""
    os.makedirs(folder, exist_ok=True)
    lines = [f'{k} = "{v}"' if isinstance(v, str) else f"{k} = {v}" for k, v in DEFAULTS.items()]
    for name, body in (("framequarry.toml", "\n".join(lines) + "\n"), ("urls.txt", "# one id or address a line\n")):
        path = os.path.join(folder, name)
        if not os.path.exists(path):
            with open(path, "w") as f:
                f.write(body)


def _queue(spark, got) -> None:
    """The resolver's commit log: a batch resolved, ids claimed by a worker for an hour, or the rows of its tables and what is still out."""
    from framequarry import models
    from framequarry.operators import joins
    from framequarry.sinks.commits import CommitLog
    from framequarry.sources import readers
    from framequarry.streaming import batch_resolver
    from framequarry.streaming.claims import Claims

    log = CommitLog(spark, got.log)
    if got.command == "ls":
        s = log.snapshot()
        for name in sorted(s.tables):
            print(name, s.table(name).count())
        print("out", batch_resolver.queue_depth(log))
        return
    ids = readers.url_list(spark, got.urls)
    if got.command == "take":
        found = Claims(log, ids, in_flight=got.most).take(got.worker, got.most, time.time())
    else:
        ledgers = [readers.ledger(spark, x) for x in got.ledger]
        waiting = joins.pending(ids, *ledgers)
        found = batch_resolver.resolve_batch(log, waiting, waiting.select("id").limit(0), models.caller(got.model), time.time(), got.batch)
    for r in found.orderBy("id").toLocalIterator():
        print(r.id)


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="framequarry", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("init").add_argument("folder")
    a = sub.add_parser("pending")
    a.add_argument("urls")
    a.add_argument("--ledger", action="append", default=[])
    a.add_argument("--out")
    a = sub.add_parser("status")
    a.add_argument("markers")
    a.add_argument("--expected", type=int, required=True)
    a = sub.add_parser("resolve")
    a.add_argument("urls")
    a.add_argument("log")
    a.add_argument("--ledger", action="append", default=[])
    a.add_argument("--model", default="address")
    a.add_argument("--batch", type=int, default=20)
    a = sub.add_parser("take")
    a.add_argument("urls")
    a.add_argument("log")
    a.add_argument("--worker", required=True)
    a.add_argument("--most", type=int, default=5)
    sub.add_parser("ls").add_argument("log")
    a = sub.add_parser("run")
    a.add_argument("query")
    a.add_argument("tables")
    a.add_argument("--out")
    got = p.parse_args(args)
    if got.command == "init":
        starter(got.folder)
        return 0
    from framequarry.operators import joins, route
    from framequarry.queries import QUERIES
    from framequarry.session import session
    from framequarry.sources import readers

    spark = session("framequarry-cli")
    if got.command == "pending":
        ids = joins.pending(readers.url_list(spark, got.urls), *(readers.ledger(spark, x) for x in got.ledger)).orderBy("ord").select("id")
        if got.out:
            ids.write.mode("overwrite").text(got.out)
        else:
            for r in ids.toLocalIterator():
                print(r.id)
    elif got.command == "status":
        report = route.barrier(readers.status_table(spark, got.markers), got.expected)
        report.show()
        return 0 if report.first()["complete"] else 1
    elif got.command in ("resolve", "take", "ls"):
        _queue(spark, got)
    else:
        out = QUERIES[got.query](spark, got.tables)
        out.write.mode("overwrite").parquet(got.out) if got.out else out.limit(100).select([F.col(c) for c in out.columns]).show(100, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
