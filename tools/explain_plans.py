"""Print the executed (post-AQE) physical plans of the hit query's stages.

    python tools/explain_plans.py [SF_DIR]

Shows the candidate stage (pushed scan filters, broadcast watchlist semi
join, partial singleton aggregation) and the final enrichment stage (range-
pruned lookup scans, broadcast semi joins, first-hit window group limit).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gatewatch import Window, fixture_tables  # noqa: E402
from gatewatch.plans import hits as H  # noqa: E402
from gatewatch.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    t = fixture_tables(spark, sf_dir)
    w = Window.parse("2024-01-10 00:00:00", "2024-01-12 08:00:00")
    limits = H.HitLimits()
    watchlist = H.named_watchlist(t, "ASIA", limits)
    cand = H.hit_candidates(t, w, watchlist)
    print("=== candidate stage ===")
    cand.explain("formatted")
    ck, keys = H.materialize_and_measure(cand, H.CANDIDATE_KEYS, limits)
    hits = H.enrich_candidates(t, ck, keys, watchlist, True, limits)
    hits.collect()
    print("=== enrichment stage (after execution, AQE final plan) ===")
    hits.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
