"""python -m leafmill QUERY FOLDER [OUT]: runs a query of the catalogue; writes Parquet to OUT or shows rows."""

from __future__ import annotations

import sys

from leafmill.plans import catalogue
from leafmill.session import local_session


def main(args: list[str]) -> int:
    if len(args) < 2 or args[0] not in catalogue.QUERIES:
        print(__doc__, "\n".join(sorted(catalogue.QUERIES)), sep="\n")
        return 2
    rows = catalogue.QUERIES[args[0]](local_session(), args[1])
    if len(args) > 2:
        rows.write.mode("overwrite").parquet(args[2])
    else:
        rows.show(50, truncate=100)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
