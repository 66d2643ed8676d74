"""Headline benchmark: pairing, clustering and one relocation step at $BENCH_SF_DIR."""

from __future__ import annotations

import json
import os
import threading
import time

from quakespark import adapter
from quakespark.operators import cluster, links as lnk
from quakespark.params import IterationParams, RelocationParams
from quakespark.plans.relocate import relocate
from quakespark.registry import common
from quakespark.registry.core import Tables
from quakespark.registry.relocation_rows import LAYERED
from quakespark.session import checkpointed, local_session

#: Seconds after which the relocation step is stopped.
LIMIT = 300.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "quakespark-bench")
    t = Tables(spark, folder)
    times: dict[str, float] = {}

    def timed(name, work):
        begin = time.perf_counter()
        out = work()
        times[name] = round(time.perf_counter() - begin, 3)
        return out

    # warm the JVM on the smallest query before anything is timed
    adapter.view(spark, folder, "v_station").count()
    timed("v_pick", lambda: t("v_pick").count())
    timed("W1_linked_pairs", lambda: common.linked_pairs(t).count())
    ct = timed("W2_differential_times", lambda: checkpointed(common.catalog_links(t)))
    links = lnk.one_table(None, ct)
    timed("A2_pair_strength", lambda: cluster.pair_strength(links).count())
    timed("A4_clusters", lambda: cluster.cluster_events(links, t("v_event"), 0, 30).count())
    kept = lnk.with_separation(links, t("v_event"))
    # the step alone: error probes are extra right-hand sides that only last steps of a run solve
    step = RelocationParams(schedule=(IterationParams(last=1, w_ctp=1.0, w_cts=0.5, damp=30.0),), errors=False)
    # stopped after its limit, which then stands as its time and is named in the output
    limit = threading.Timer(LIMIT, spark.sparkContext.cancelAllJobs)
    limit.start()
    stopped = []
    try:
        timed("R17_one_iteration", lambda: relocate(kept, t("v_event"), t("v_station"), LAYERED, step).relocations.count())
    except Exception:
        if limit.is_alive():
            raise
        times["R17_one_iteration"] = LIMIT
        stopped.append("R17_one_iteration")
    limit.cancel()
    print(
        json.dumps(
            {
                "metric": "pairing, clustering and one relocation step",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
                "stopped_at_limit": stopped,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
