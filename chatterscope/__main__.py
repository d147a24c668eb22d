"""Command line: python -m chatterscope JOB --source ... --out ... (submit with spark-submit)."""

from __future__ import annotations

import argparse
import inspect

from chatterscope.plans import jobs
from chatterscope.session import get_spark

JOBS = {
    "monthly-phrases": jobs.monthly_phrases,
    "community-phrases": jobs.community_phrases,
    "daily-phrases": jobs.daily_phrases,
    "daily-statistics": jobs.daily_statistics,
    "author-graph": jobs.author_graph,
    "graph-file": jobs.graph_file,
    "search-index": jobs.search_index,
    "page-backlinks": jobs.page_backlinks,
    "daily-documents": jobs.daily_documents,
    "message-table": jobs.message_table,
    "follower-walk": jobs.follower_walk,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chatterscope", description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=inspect.getdoc(job).splitlines()[0])
        for key, param in list(inspect.signature(job).parameters.items())[1:]:
            required = param.default is inspect.Parameter.empty
            kind = int if "int" in str(param.annotation) else str
            if "bool" in str(param.annotation):
                kind = lambda word: word.lower() in ("true", "yes", "1")
            command.add_argument(
                "--" + key.replace("_", "-"),
                type=kind,
                required=required,
                default=None if required else param.default,
            )
    return top


def main(argv: list[str] | None = None) -> None:
    options = vars(parser().parse_args(argv))
    job = options.pop("job")
    JOBS[job](get_spark(f"chatterscope {job}"), **options)


if __name__ == "__main__":
    main()
