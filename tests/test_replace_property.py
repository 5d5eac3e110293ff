"""Replace semantics as a property: after any sequence of re-deliveries, reruns and
loads, Gold and the mart equal a fresh build from the Bronze that is there now."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import write_csv
from daybook.schema import GOLD_COLUMNS
from daybook.plans import pipeline
from daybook.session import scratch_dir
from daybook.sources import bronze, mart

HEADER = "event_id,user_id,event_type,product_id,event_timestamp,amount\n"
DATES = ["2026-05-01", "2026-05-02", "2026-05-03"]

# (date index, number of good rows, seed); zero good rows = a delivery that cleans to nothing
steps = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4), st.integers(0, 99)),
                 min_size=1, max_size=4)


def _deliver(paths, date, good, seed):
    lines = [f"e{seed}-{i},{seed % 7 + i},purchase,{(seed + i) % 3 + 1},{date}T0{i}:00:00,"
             f"{seed + i}.25\n" for i in range(good)]
    lines.append(f"bad{seed},1,view,1,garbage,0.0\n")  # always one rejected row
    write_csv(bronze.date_path(paths.bronze, date), "part.csv", HEADER + "".join(lines))


def _state(spark, paths):
    g = sorted(tuple(r) for r in pipeline.gold_for(spark, paths)
               .select(*GOLD_COLUMNS).collect())
    m = sorted(tuple(r) for r in mart.mart_view(spark, paths.mart).collect())
    return g, m


@settings(max_examples=6, deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(steps)
def test_any_rerun_sequence_equals_a_fresh_build(spark, ops):
    root = scratch_dir(spark, "replace-prop")
    paths = pipeline.Paths.under(root)
    for idx, good, seed in ops:
        d = DATES[idx]
        _deliver(paths, d, good, seed)
        pipeline.daily_run(spark, paths, d)
        pipeline.load(spark, paths, [d])
    delivered = [d for d in DATES if bronze.present_dates(spark, paths.bronze, [d])[0]]
    fresh = pipeline.Paths.under(scratch_dir(spark, "replace-fresh"), bronze_root=paths.bronze)
    pipeline.run_dates(spark, fresh, delivered)
    pipeline.load(spark, fresh, delivered)
    assert _state(spark, paths) == _state(spark, fresh)
