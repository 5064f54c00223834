"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Every query is run
to its full result (no-op sink), after an untimed run of the first one as warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from concord.queries import REGISTRY  # noqa: E402
from concord.session import build_session  # noqa: E402

HEADLINE = (
    "golden_part",
    "mode_first",
    "mode_first_wide",
    "median_low",
    "deviation_filter",
    "deviation_wide",
    "price_range",
    "fuzzy_name_vote",
    "golden_wide",
    "fx_convert",
    "identify_responses",
    "candidate_cascade",
    "company_security_quote",
    "first_seen",
    "text_upper",
    "validate_split",
    "latest_snapshot",
    "snapshot_upsert",
    "upper_median",
    "key_figures",
    "stream_convert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    timed(HEADLINE[0])
    seconds = {name: timed(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
