"""Run a program over a file and print its tables, or write them with ``--output``.

``python -m linefit PROGRAM PATH`` or ``spark-submit … submit.py PROGRAM PATH``; master, memory
and everything else come from there.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from linefit.plans.programs import PROGRAMS, RECORDS, SPLITTING

SHOWN = 100


def main() -> None:
    parser = argparse.ArgumentParser(prog="linefit", description=__doc__)
    parser.add_argument("program", choices=sorted(PROGRAMS))
    parser.add_argument("path", help="input file or folder")
    parser.add_argument("--output", help="folder to write each table to, as parquet")
    parser.add_argument(
        "--per-row", action="store_true",
        help="split by a draw for each row, not by the line's text (which keeps equal lines together)",
    )
    parser.add_argument(
        "--multiline", action="store_true", help="quoted fields of the file may hold line breaks"
    )
    arguments = parser.parse_args()
    if arguments.per_row and arguments.program not in SPLITTING:
        parser.error(f"--per-row is for {', '.join(SPLITTING)}")
    if arguments.multiline and arguments.program not in RECORDS:
        parser.error(f"--multiline is for {', '.join(RECORDS)}")
    more = {"keys": None} if arguments.per_row else {}
    if arguments.multiline:
        more["reader"] = RECORDS[arguments.program]
    spark = SparkSession.builder.appName(f"linefit {arguments.program}").getOrCreate()
    for name, table in PROGRAMS[arguments.program](spark, arguments.path, **more).items():
        if arguments.output:
            table.write.parquet(f"{arguments.output}/{name}")
        else:
            print(name)
            rows = table.limit(SHOWN + 1).collect()
            spark.createDataFrame(rows[:SHOWN], table.schema).show(SHOWN, truncate=False)
            if len(rows) > SHOWN:
                print(f"… and more rows than the {SHOWN} shown; --output writes all")


if __name__ == "__main__":
    main()
