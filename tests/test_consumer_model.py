"""The serving views (C7, C8, C9) against a brute-force model of the consumer.

The model walks the messages one by one in arrival order, as the consumer
does: the tiles take the last fresh message, the live buffer appends and drops
its oldest beyond 100, the forecast buffer appends two rows and is cut to its
last 600 when it passes 800. The Spark views must hold the same rows for any
message sequence, including the strict window bounds, missing prices, times
sent twice, and enough messages to hit both caps. (Where the consumer would
fail on two prices for one time and model, the latest arrival wins: B12.)
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridcast.operators import views

NOW = dt.datetime(2024, 1, 15, 12, 0, 0)
RF, GBT = views.RF_LABEL, views.GBT_LABEL

# Offsets from "now" in seconds: the window bounds and their neighbours, plus
# a few ordinary values (repeats make times collide).
OFFSETS = [-43201, -43200, -43199, -7200, -7199, 0, 600, 3600, 3601, 7199, 7200, 86399, 86400, 90000, 200000]
PRICES = [None, 0.0, 29.99, 30.0, 55.5, 80.0, 80.01, 120.0]

message = st.tuples(st.sampled_from(OFFSETS), st.sampled_from(PRICES), st.sampled_from([None, 3.5]))
FUTURE = [o for o in OFFSETS if o > 3600]
future_heavy = st.tuples(
    st.one_of(st.sampled_from(FUTURE), st.sampled_from(FUTURE), st.sampled_from(FUTURE), st.sampled_from(OFFSETS)),
    st.sampled_from(PRICES),
    st.sampled_from([None, 3.5]),
)


def simulate(msgs):
    tile, live, fc = None, [], []
    for arrival, (off, price, wind) in enumerate(msgs):
        t = NOW + dt.timedelta(seconds=off)
        rf = 0.0 if price is None else price
        gbt = 0.0 if price is None else price * 1.5
        w = 0.0 if wind is None else wind
        d = (t - NOW).total_seconds()
        if abs(d) < 7200:
            tile = (t, rf, w)
        if -12 < d / 3600 < 24:
            live.append((t, rf, w))
            if len(live) > 100:
                live.pop(0)
        if d > 3600:
            fc.append((t, rf, RF))
            fc.append((t, gbt, GBT))
            if len(fc) > 800:
                fc = fc[-600:]
    first = {}
    for t, p, w in live:
        first.setdefault(t, (p, w))
    latest = {}
    for t, p, m in fc:
        latest[(t, m)] = p
    table = {t: (latest.get((t, RF)), latest.get((t, GBT))) for t, _ in latest}
    return tile, first, sorted((t, m, p) for t, p, m in fc), table


def frame(spark, msgs):
    rows = [
        ((NOW + dt.timedelta(seconds=off)).strftime("%Y-%m-%dT%H:%M:%S"), 1.0, wind, price, None if price is None else price * 1.5, i)
        for i, (off, price, wind) in enumerate(msgs)
    ]
    schema = "time string, temperature double, wind_speed double, price_rf double, price_gbt double, arrival long"
    return spark.createDataFrame(rows, schema).repartition(3)


def check(spark, msgs):
    tile, first, buffer, table = simulate(msgs)
    pred = frame(spark, msgs)

    cc = views.current_conditions(pred, NOW).collect()
    if tile is None:
        assert cc == []
    else:
        assert [(r.Time, r.price, r.wind_speed) for r in cc] == [tile]

    got_live = {r.Time: (r.Price, r.Wind) for r in views.live_series(pred, NOW).collect()}
    assert got_live == first

    got_buf = sorted((r.Time, r.Model, r.Price) for r in views.forecast_buffer(pred, NOW).collect())
    assert got_buf == buffer

    got_table = {r.Time: (r[RF], r[GBT]) for r in views.model_comparison(pred, NOW).collect()}
    assert got_table == table


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(message, min_size=0, max_size=60))
def test_views_match_consumer_short_sequences(spark, msgs):
    check(spark, msgs)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow, HealthCheck.data_too_large, HealthCheck.large_base_example])
@given(st.lists(future_heavy, min_size=560, max_size=700))
def test_views_match_consumer_past_both_caps(spark, msgs):
    future = sum(1 for off, _, _ in msgs if off > 3600)
    in_today = sum(1 for off, _, _ in msgs if -43200 < off < 86400)
    assert 2 * future > 800 and in_today > 100  # both buffers have been cut
    check(spark, msgs)
