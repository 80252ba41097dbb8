"""Plans of all queries, those behind stored tables included."""

import os
import re
import sys

import pytest

from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
# The published settings need longer series than the smallest tables have.
LONGER = {"f1_scaled_features", "f2c_linear_forecast", "f4_event_forecast", "f5_event_selection", "f6_event_best"}
# These fit trees many times over; their plans are those of the windows that the others have.
SLOW = {"f2_tcn_forecast", "f2_lstm_forecast", "f2_autoformer_forecast", "f2_scinet_forecast", "f2d_event_forecast", "f6_event_best_of_all"}


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def depth(line: str) -> int:
    return len(re.match(r"[\s:+\-*()\d]*", line)[0])


def faults(text: str) -> list[str]:
    found = [x for x in ("CartesianProduct", "BatchEvalPython") if x in text]
    lines = [x for x in text.splitlines() if "InitialPlan" not in x]
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next((x for x in lines[i + 1 :] if depth(x) > depth(line)), "")
            # One row per task, or the first rows of each: sums and tops, not raw rows.
            if not re.search(r"Aggregate|Limit|TakeOrdered", below):
                found.append(f"single partition over {below.strip()[:80]}")
        if "BroadcastNestedLoopJoin" in line and "Cross" not in line and "Inner" not in line and "LeftOuter" not in line:
            found.append(line.strip()[:80])
    return found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_no_query_gathers_rows(spark, monkeypatch, name):
    """No raw rows in one partition, no per-row Python, no cross join of rows, before stored tables or after."""
    plans = []

    def recording(keep):
        def run(df, *args):
            plans.append(planned(df))
            return keep(df, *args)

        return run

    from gridtide import session

    for owner in [m for n, m in list(sys.modules.items()) if n.startswith(("gridtide.", "checks.")) and not n.startswith("gridtide.llm")]:
        for function in ("materialise", "stored"):
            if getattr(owner, function, None) is getattr(session, function) and owner is not session:
                monkeypatch.setattr(owner, function, recording(getattr(session, function)))
    plans.append(planned(QUERIES[name](spark, "/root/testdata/sf0.01" if name in LONGER else FOLDER)))
    assert not [f for text in plans for f in faults(text)]
