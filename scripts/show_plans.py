"""Print the physical plans of headline check queries as they run at scale.

Usage: python scripts/show_plans.py [sf_dir]

The plans are those of the registered queries themselves. Large inputs are
simulated by switching automatic broadcasts off (a big side would exceed the
threshold). Prints the tree part of ``explain("formatted")`` for each plan.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.checks import queries  # noqa: E402
from tidemark.session import local_session  # noqa: E402

NAMES = ("customer_profile", "profile_orders", "customer_event", "upsert_lineitem")


def tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0].strip() if "\n\n\n" in text else text.split("\n(1)")[0].strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name in NAMES:
        print(f"### {name}\n\n```\n{tree(queries()[name](spark, sf_dir))}\n```\n")


if __name__ == "__main__":
    main()
