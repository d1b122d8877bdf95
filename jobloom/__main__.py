"""``python -m jobloom mail PATH|- [--queue FOLDER]``: the job links of a mail, shown or published."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from jobloom.operators import links
from jobloom.plans import flows
from jobloom.sources import boards, queue


def main(args: list[str], spark: SparkSession | None = None, stdin=None) -> int:
    parser = argparse.ArgumentParser(prog="jobloom", description=__doc__)
    command = parser.add_subparsers(dest="command", required=True).add_parser("mail", help="job links of a mail")
    command.add_argument("path", help="a file, a folder of files, or - for standard input")
    command.add_argument("--queue", help="folder of the queue to publish to")
    given = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("jobloom").getOrCreate()
    mails = boards.read_mails(spark, given.path, stdin)
    if given.queue:
        now = datetime.now(UTC).isoformat()
        bodies = flows.newsletter(mails, F.lit(now))
        before = queue.Log(given.queue).end()
        queue.publish(bodies, given.queue)
        print(f"published {queue.Log(given.queue).end() - before} messages")
    else:
        for row in links.preview(links.job_entries(mails)).collect():
            print(f"[{row.rank}] {row.title}\n    {row.company or ''} | {row.location or ''} | {row.salary or ''}\n    url={row.url}" + (f"\n    summary={row.summary}" if row.summary else ""))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
