"""Write PLANS.md: physical plan tree and scan details of the headline queries.

    python plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verbatim.operators.bigrams import bigram_occurrences, count_bigrams  # noqa: E402
from verbatim.plans.testdata import QUERIES, responses  # noqa: E402
from verbatim.session import checkpoint_dir, get_spark  # noqa: E402

SHOW = ["bigram_counting_job", "bigram_network_edges", "panel_response_table", "panel_bigram_edges", "event_fill_forward",
        "event_fill_forward_skewed", "wave_full_join", "wave_fold", "wave_stack", "zip_lookup",
        "response_view", "catalog_audit"]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    checkpoint_dir(spark, tempfile.mkdtemp(prefix="verbatim-plans-ckpt-"))
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `plan_report.py` on `{sf_dir}` (before AQE re-planning). "
           "Scans list only the columns read and the filters pushed into Parquet.", ""]
    queries = dict(QUERIES)
    # the job that fills the counts checkpoint (bigram_* queries read that checkpoint)
    queries["bigram_counting_job"] = lambda s, d: count_bigrams(bigram_occurrences(responses(s, d)))
    for name in SHOW:
        text = formatted(queries[name](spark, sf_dir))
        tree = text.split("\n\n\n")[0].strip()
        scans = []
        for block in text.split("\n\n"):
            if re.match(r"\(\d+\) Scan parquet", block.strip()):
                keep = [ln for ln in block.strip().splitlines()
                        if ln.startswith(("(", "PushedFilters", "ReadSchema"))]
                scans.append("\n".join(keep))
        out += [f"## {name}", "", "```", tree, "```", ""]
        if scans:
            out += ["```", "\n\n".join(scans), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
