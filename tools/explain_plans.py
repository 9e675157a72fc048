"""Write the physical plans of the headline queries (after execution, so AQE's
final plan shows) to a file. The results are small (at most a few
thousand rows at sf0.1) and are fetched only so the frame's own plan runs.

    python tools/explain_plans.py plans.md [/root/testdata/sf0.1]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from watchfold.plans.registry import QUERIES  # noqa: E402
from watchfold.session import build_session, ensure_checkpoint_dir  # noqa: E402

NAMES = ["fact_interaction", "fact_behavior", "program_duration_stats", "top10_by_program",
         "label_genres", "bridge_synth"]


def main(argv):
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    out = ["# Physical plans of the headline queries", "",
           f"Final adaptive plans after one execution on `{sf_dir}`, `local[8]`, "
           f"Spark {spark.version}. Regenerate with `python tools/explain_plans.py`.", ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        df.collect()          # runs this frame's own plan, so explain shows AQE's final plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        out += [f"## `{name}`", "", "```", buf.getvalue().rstrip(), "```", ""]
    with open(argv[1], "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
