"""Run one job with spark-submit.

    spark-submit --py-files tremorlake.zip submit.py daily \
        --staged /feed/20240130 --root /lake --table quakes.daily --run-date 2024-01-30
    spark-submit --py-files tremorlake.zip submit.py report --table quakes.daily
"""

from __future__ import annotations

import argparse
import datetime as dt

from tremorlake.plans import jobs
from tremorlake.plans.report import report, stored_summary
from tremorlake.session import build_session, scratch_dir
from tremorlake.sources.layers import read_staged
from tremorlake.sources.tables import scan_table


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["historical", "daily", "append", "canonical", "audited", "report"])
    parser.add_argument("--table", required=True, help="gold table")
    parser.add_argument("--staged", help="folder or glob of raw documents, one file each")
    parser.add_argument("--root", help="folder of the bronze and silver layers")
    parser.add_argument("--run-date", type=dt.date.fromisoformat, help="day of the layers, or end of the report's week")
    parser.add_argument("--feed", default="daily", help="feed name in the layer paths")
    parser.add_argument("--audit-table", help="audit table of an audited load")
    parser.add_argument("--job-id", default="0")
    parser.add_argument("--on-error", choices=["truncate", "skip"], default="truncate")
    parser.add_argument("--without-place", action="store_true")
    parser.add_argument("--n-files", type=int, help="silver files of a canonical load")
    parser.add_argument("--by-feature", action="store_true", help="a canonical load of documents too large for one task")
    parser.add_argument("--load-id", help="makes an append or canonical load one that can be run again")
    chosen = parser.parse_args(arguments)
    needed = [] if chosen.job == "report" else ["staged", "root", "run_date"]
    needed += ["audit_table"] if chosen.job == "audited" else []
    missing = [name for name in needed if getattr(chosen, name) is None]
    if missing:
        parser.error(f"{chosen.job} needs " + ", ".join("--" + name.replace("_", "-") for name in missing))
    return chosen


def main(arguments: list[str] | None = None) -> None:
    chosen = parse(arguments)
    spark = build_session(f"tremorlake {chosen.job}")
    if chosen.job == "report":
        gold = scan_table(spark, chosen.table)
        summary = stored_summary(gold, scratch_dir(spark, "summary"))
        for question, answer in report(gold, summary, chosen.run_date).items():
            print(question)
            answer.show(truncate=False)
        return

    where = {"root": chosen.root, "run_date": chosen.run_date, "table": chosen.table}
    if chosen.job == "audited":
        result = jobs.audited_load(
            chosen.staged, feed=chosen.feed, audit_table=chosen.audit_table, job_id=chosen.job_id, spark=spark, **where
        )
    else:
        documents = read_staged(spark, chosen.staged)
        if chosen.job == "historical":
            result = jobs.historical_load(documents, **where)
        elif chosen.job == "daily":
            result = jobs.daily_load(documents, **where)
        elif chosen.job == "append":
            result = jobs.append_load(documents, feed=chosen.feed, load_id=chosen.load_id, **where)
        else:
            result = jobs.canonical_load(
                documents,
                feed=chosen.feed,
                include_place=not chosen.without_place,
                on_error=chosen.on_error,
                n_files=chosen.n_files,
                by_feature=chosen.by_feature,
                load_id=chosen.load_id,
                **where,
            )
    print(result)


if __name__ == "__main__":
    main()
