"""Write PLANS.md: the final (adaptive) physical plans of the headline
queries at $BENCH_SF_DIR (default sf0.1), for plan review.

usage: python tools/plans.py [key ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.catalog import queries as Q  # noqa: E402
from tarmac.plans.staging import stage  # noqa: E402
from tarmac.session import local_session  # noqa: E402
from tarmac.sources.star_adapter import bronze_from_star  # noqa: E402

KEYS = ["mod_01", "mod_05", "mod_06", "mod_10", "mod_11", "win_01", "dq_10", "dq_21", "joi_04", "agg_18"]


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    text = buf.getvalue()
    return text.split("+- == Initial Plan ==")[0]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    keys = sys.argv[1:] or KEYS
    spark = local_session(cores=8, shuffle_partitions=16)
    out = [f"# Final physical plans ({sf_dir}, local[8], AQE on)\n",
           "Generated by `tools/plans.py`. `AQEShuffleRead local` / `BroadcastQueryStage` mark joins that AQE "
           "turned into broadcasts after measuring the small side; `WindowGroupLimit` below an `Exchange` is "
           "the map-side part of latest-wins dedupe; `partial_*` aggregates run before the shuffle; "
           "`ReusedExchange` is a broadcast built once and shared by several branches.\n"]
    if not sys.argv[1:]:
        # what the staging lineage cut writes: adapter, dedupe and cleaning
        build = stage(bronze_from_star(spark, sf_dir))
        out.append("## staging build\nThe frame `layers()` writes once into the checkpoint folder "
                   "(every model query then reads the written table).\n\n```\n"
                   + final_plan(build).strip() + "\n```\n")
    for key in keys:
        df = Q.QUERIES[key](spark, sf_dir)
        doc = (Q.QUERIES[key].__doc__ or "").strip().splitlines()
        out.append(f"## {key}\n" + (f"{doc[0]}\n" if doc else "") + "\n```\n" + final_plan(df).strip() + "\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
