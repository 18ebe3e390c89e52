"""Print the physical plan shape of registered queries as it would be at scale.

Emulates large tables on the small fixtures: dimension broadcasts are allowed
only up to 30 rows (nation and region stay broadcast, as their size is fixed),
and Spark's own size-based broadcast is off, so every fact join shows as the
shuffle join it would be on a cluster. Usage: python tools/plan_report.py [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contrail.plans.queries import QUERIES  # noqa: E402
from contrail.session import build_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Aggregate|Window|GroupLimit|TakeOrdered|Scan|Generate|Union|BroadcastExchange|"
                  r"Sort \[|Expand|Limit)")


def shape(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    out = []
    for line in buf.getvalue().splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
        out.append(line[:170])
    return out


def main() -> None:
    spark = build_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "contrail.broadcast.maxBytes": "4000"})
    # By default only read-only queries: write-through ones write at construction.
    default = sorted(n for n, f in QUERIES.items() if "Writes" not in (f.__doc__ or ""))
    for name in sys.argv[1:] or default:
        print(f"### {name}\n```")
        print("\n".join(shape(QUERIES[name](spark, "/root/testdata/sf0.001"))))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
