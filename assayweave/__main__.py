"""``python -m assayweave`` with ``build IN OUT``, ``evaluate PREDICTIONS GOLD SCOPE MISSING``, ``site RECORDS ARTICLES TABLES OUT`` or ``fetch MANIFEST URL FOLDER``.

``URL`` holds ``{pmcid}``.  A fetched file whose hash is not the manifest's is refused.
"""

from __future__ import annotations

import sys

from assayweave.operators import article_tables, enrich, evaluate
from assayweave.session import build_session
from assayweave.sources import paged_api, readers, writers


def main(args: list[str]) -> int:
    if len(args) == 3 and args[0] == "build":
        spark = build_session()
        parsed = article_tables.parse_articles(spark.read.parquet(args[1]), on_error="skip")
        records, skipped = article_tables.measurements(parsed)
        records.write.mode("overwrite").parquet(f"{args[2]}/records")
        skipped.write.mode("overwrite").parquet(f"{args[2]}/skipped")
        return 0
    if len(args) == 5 and args[0] == "evaluate":
        spark = build_session()
        row = evaluate.evaluate(*(spark.read.parquet(path) for path in args[1:])).first().asDict()
        print(row)
        return int(evaluate.error_count(row) > 0)
    if len(args) == 5 and args[0] == "site":
        spark = build_session()
        records, articles, tables = (spark.read.parquet(path) for path in args[1:4])
        writers.write_snapshot(enrich.reviewed_view(records), articles, tables, args[4])
        return 0
    if len(args) == 4 and args[0] == "fetch":
        for row in readers.read_manifest(build_session(), args[1]).select("pmcid", "filename", "sha256").toLocalIterator():
            paged_api.cached_fetch(args[2].format(pmcid=row["pmcid"]), f"{args[3]}/{row['filename']}", row["sha256"])
        return 0
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
