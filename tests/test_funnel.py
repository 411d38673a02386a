import random
from itertools import product

import pytest

from touchline.operators.funnel import STEPS, funnel_by_channel, funnel_progress

HOUR = 3_600_000_000
SCHEMA = "user_pseudo_id string, event_name string, event_timestamp long, channel string"


def brute(rows, limit_hours):
    """First time each step is reached, over all chains of events; of several chains the one that starts last."""
    out = set()
    for user in {r[0] for r in rows if r[0] is not None}:
        own = [(r[2], STEPS.index(r[1]), r[3]) for r in rows if r[0] == user and r[1] in STEPS]
        ends = {(t, t, c) for t, s, c in own if s == 0}  # (start, end, channel)
        for step in range(len(STEPS)):
            if step:
                ends = {(a, t, c) for (a, z, c), (t, s, _) in product(ends, own) if s == step and t > z and t - a <= limit_hours * HOUR}
            if ends:
                first = min(z for _, z, _ in ends)
                a, _, c = max(((a, z, c) for a, z, c in ends if z == first), key=lambda x: (x[0], x[2]))
                out.add((user, step + 1, first, a, c))
    return out


@pytest.mark.parametrize("bucket_hours,limit_hours", [(24, 72), (1, 5), (7, 3), (1000, 20)])
def test_against_all_chains(spark, bucket_hours, limit_hours):
    r = random.Random(bucket_hours)
    rows = []
    for u in range(40):
        for _ in range(r.randrange(1, 25)):
            name = r.choice([*STEPS, "session_start"])
            rows.append((f"u{u}", name, r.randrange(0, 60) * HOUR // r.choice([1, 2]), r.choice("abc")))
    rows += [(None, "page_view", 5, "a"), ("x", "page_view", -3 * HOUR, "a"), ("x", "add_to_cart", -2 * HOUR, "b"), ("x", "begin_checkout", HOUR, "b")]
    df = spark.createDataFrame(rows + rows[:30], SCHEMA)
    got = {tuple(x) for x in funnel_progress(df, limit_hours=limit_hours, bucket_hours=bucket_hours).collect()}
    assert got == brute(rows, limit_hours)


def test_each_step_strictly_after_the_last(spark):
    rows = [("u", "page_view", 10, "a"), ("u", "add_to_cart", 10, "a"), ("u", "begin_checkout", 20, "a")]
    assert [x.step for x in funnel_progress(spark.createDataFrame(rows, SCHEMA)).collect()] == [1]


def test_a_later_start_saves_a_passage_that_ran_out(spark):
    rows = [("u", "page_view", 0, "old"), ("u", "add_to_cart", HOUR, "-"), ("u", "page_view", 70 * HOUR, "new"), ("u", "add_to_cart", 71 * HOUR, "-"),
            ("u", "begin_checkout", 80 * HOUR, "-"), ("u", "purchase", 90 * HOUR, "-")]
    got = {x.step: (x.channel, x.reached_at // HOUR) for x in funnel_progress(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: ("old", 0), 2: ("old", 1), 3: ("new", 80), 4: ("new", 90)}


def test_users_and_medians(spark):
    rows = [(u, "page_view", 0, "a") for u in "uvw"] + [(u, "add_to_cart", s * 1_000_000 + 999, "z") for u, s in (("u", 10), ("v", 20))]
    got = {x.step: (x.channel, x.users, x.median_seconds, x.step_name) for x in funnel_by_channel(funnel_progress(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {1: ("a", 3, 0.0, "page_view"), 2: ("a", 2, 15.0, "add_to_cart")}
    assert funnel_progress(spark.createDataFrame([], SCHEMA)).collect() == []
