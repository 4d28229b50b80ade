"""Property tests: the skew-safe moving average against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleet_fixtures import frames, reading, unit
from fleetpulse.operators.windows import moving_mean

series_sizes = st.lists(st.integers(min_value=1, max_value=40), min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=series_sizes, bound=st.integers(min_value=1, max_value=200),
       rows=st.integers(min_value=1, max_value=5), seed=st.integers(0, 10_000))
def test_moving_mean_matches_brute_force(spark, bucket_minutes, sizes, bound, rows, seed):
    import random

    rnd = random.Random(seed)
    data, rid = [], 0
    for uid, n in enumerate(sizes, start=1):
        for i in range(n):
            # equal timestamps on purpose: reading_id orders them
            data.append(reading(rid, uid, 15 * (i // 2), round(rnd.uniform(-10, 10), 3)))
            rid += 1
    r, _ = frames(spark, data, [unit(k) for k in range(1, len(sizes) + 1)])
    bucket_minutes(bound)
    got = {x.reading_id: x.mv for x in moving_mean(r, "avg_temp_c", "mv", rows).collect()}
    want = {}
    for uid in range(1, len(sizes) + 1):
        mine = sorted((x for x in data if x["unit_id"] == uid),
                      key=lambda x: (x["timestamp"], x["reading_id"]))
        for i, x in enumerate(mine):
            frame = [y["avg_temp_c"] for y in mine[max(0, i - rows + 1): i + 1]]
            want[x["reading_id"]] = sum(frame) / len(frame)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
