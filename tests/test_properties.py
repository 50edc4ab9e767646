"""Property tests: pairing and numbering on random inputs against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flotilla.operators.pairs import attach_previous, row_numbers

ROWS = st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]), st.integers(0, 20_000)),
                min_size=1, max_size=40)


def _brute(rows, scope):
    keyed = sorted(((v is not None, v or "", t, i) for i, (v, t) in enumerate(rows)))
    prev, num, last_v, n = {}, {}, object(), 0
    for pos, (has, v, t, i) in enumerate(keyed):
        vid = v if has else None
        if scope == "vehicle":
            same = pos > 0 and (keyed[pos - 1][0], keyed[pos - 1][1]) == (has, v)
            prev[i] = keyed[pos - 1][3] if same else None
            n = n + 1 if vid == last_v and pos > 0 and same else 1
            last_v = vid
        else:
            prev[i] = keyed[pos - 1][3] if pos > 0 else None
            n += 1
        num[i] = n
    return prev, num


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, scope=st.sampled_from(["vehicle", "global"]),
       hot_rows=st.sampled_from([None, 0, 3, 1000]))
def test_pairing_and_numbering(spark, rows, scope, hot_rows):
    df = spark.createDataFrame([(i, v, t) for i, (v, t) in enumerate(rows)],
                               "event_id long, idVehiculo string, epochTime long")
    want_prev, want_num = _brute(rows, scope)
    got = attach_previous(df, scope=scope, hot_rows=hot_rows, n_ranges=3)
    assert {r[0]: r[1] for r in got.select("event_id", "prev.event_id").collect()} == want_prev
    nums = row_numbers(df, scope=scope, hot_rows=hot_rows, n_ranges=3)
    assert {r[0]: r[1] for r in nums.select("event_id", "tempField").collect()} == want_num


SCHEMA = ("matricula string, event_id long, uoid string, realTime string, latitud double, "
          "longitud double, timestamp timestamp_ntz")
POS = st.sampled_from([(40.0, -3.0), (40.1, -3.0), (None, None), (40.1, None)])


def _loop(state_rows, obs_rows, add_new):
    """The sequential replay, written plainly (test oracle)."""
    state = {r[0]: r for r in state_rows}
    entries = sorted({(r[3], r[2]) for r in obs_rows})
    moves = 0
    for _, u in entries:
        locs = {}
        for r in sorted((r for r in obs_rows if r[2] == u), key=lambda r: (r[3], r[1]), reverse=True):
            locs[r[0]] = r
        for plate, r in locs.items():
            if plate not in state:
                if add_new:
                    state[plate] = r
                continue
            old = state[plate]
            if not (r[4] == old[4] and r[5] == old[5]):
                state[plate] = r
                moves += 1
    return {k: v[1] for k, v in state.items()}, moves


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(state=st.lists(st.tuples(st.sampled_from("ABCD"), POS), max_size=4, unique_by=lambda x: x[0]),
       obs=st.lists(st.tuples(st.sampled_from("ABCDE"), st.sampled_from(["U1", "U2", "U3"]),
                              st.sampled_from(["01", "03", "05"]), POS), min_size=1, max_size=14),
       add_new=st.booleans())
def test_fold_equals_replay(spark, state, obs, add_new):
    import datetime as dt
    from flotilla.operators.state import fold_state, movement_log
    ts = dt.datetime(2024, 1, 10, 12)
    srows = [(p, i, "U0", "2024-01-10 00:00:00", lat, lon, ts) for i, (p, (lat, lon)) in enumerate(state)]
    orows = [(p, 100 + i, u, f"2024-01-10 {h}:00:00", lat, lon, ts)
             for i, (p, u, h, (lat, lon)) in enumerate(obs)]
    sdf = spark.createDataFrame(srows, SCHEMA)
    odf = spark.createDataFrame(orows, SCHEMA)
    want, want_moves = _loop(srows, orows, add_new)
    got = {r["matricula"]: r["event_id"] for r in fold_state(sdf, odf, "2024-01-10", add_new=add_new).collect()}
    assert got == want
    if not add_new:
        assert movement_log(sdf, odf, "2024-01-10").count() == want_moves


FLOODS = st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.integers(0, 4)), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=FLOODS, scope=st.sampled_from(["vehicle", "global"]), hot_rows=st.sampled_from([0, 1, 2, 5]))
def test_pairing_with_timestamp_floods(spark, rows, scope, hot_rows):
    """Many rows of one vehicle at one timestamp: the flood is cut by event_id."""
    df = spark.createDataFrame([(i, v, t) for i, (v, t) in enumerate(rows)],
                               "event_id long, idVehiculo string, epochTime long")
    want_prev, want_num = _brute(rows, scope)
    got = attach_previous(df, scope=scope, hot_rows=hot_rows, n_ranges=3)
    assert {r[0]: r[1] for r in got.select("event_id", "prev.event_id").collect()} == want_prev
    nums = row_numbers(df, scope=scope, hot_rows=hot_rows, n_ranges=3)
    assert {r[0]: r[1] for r in nums.select("event_id", "tempField").collect()} == want_num
