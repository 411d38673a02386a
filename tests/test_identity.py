import random

from touchline.operators.identity import sign_ins, stitch, stitched_users, user_identity, without_hubs
from tests.builders import ev, raw_df


def events(spark, pairs):
    return spark.createDataFrame(pairs, "user_pseudo_id string, user_id string")


def brute(pairs, most_devices):
    devices = {}
    for d, a in set(pairs):
        if d is not None and a is not None:
            devices.setdefault(a, set()).add(d)
    root = {d: d for d, _ in pairs if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    kept = {a: ds for a, ds in devices.items() if len(ds) <= most_devices}
    for ds in kept.values():
        for d in ds:
            x, y = find(d), find(min(ds))
            root[max(x, y)] = min(x, y)
    groups = {}
    for d in root:
        groups.setdefault(find(d), set()).add(d)
    accounts = {g: {a for a, ds in kept.items() if ds & members} for g, members in groups.items()}
    return sorted((d, find(d), len(groups[find(d)]), len(accounts[find(d)])) for d in root)


def test_components_by_brute_force(spark):
    r = random.Random(3)
    for seed in range(3):
        pairs = [(f"d{r.randrange(120)}", f"a{r.randrange(90)}" if r.random() < 0.8 else None) for _ in range(150)]
        pairs += [(f"d{i}", "hub") for i in range(40)] + [(None, "a1"), (None, None)]
        got = sorted(map(tuple, user_identity(events(spark, pairs), 20).collect()))
        assert got == brute(pairs, 20)


def test_a_long_chain_is_one_user_in_few_rounds(spark, monkeypatch):
    import touchline.operators.identity as identity

    rounds = []
    monkeypatch.setattr(identity, "_shortened", lambda p, f=identity._shortened: rounds.append(1) or f(p))
    order = [f"d{i:03d}" for i in range(200)]
    random.Random(1).shuffle(order)
    links = [(d, f"a{i + j}") for i, d in enumerate(order) for j in (0, 1)]
    got = stitched_users(sign_ins(events(spark, links))).collect()
    assert len(got) == 200 and {x.stitched_id for x in got} == {"d000"}
    assert len(rounds) / 2 <= 9


def test_a_hub_joins_nobody(spark):
    links = [(f"d{i}", "hub") for i in range(21)] + [("d1", "x"), ("d2", "x")]
    found = {x.user_pseudo_id: x.stitched_id for x in user_identity(events(spark, links)).collect()}
    assert found["d2"] == "d1" and sum(k != v for k, v in found.items()) == 1
    assert without_hubs(sign_ins(events(spark, links[:20]))).count() == 20


def test_empty(spark):
    assert user_identity(events(spark, [])).collect() == []
    assert [tuple(x) for x in user_identity(events(spark, [("a", None)])).collect()] == [("a", "a", 1, 0)]


def test_a_touch_on_one_device_is_credited_on_the_other(spark):
    from touchline.config import AttributionConfig
    from touchline.plans.models import Models

    raw = raw_df(spark, [ev("phone", "page_view", "2024-03-01 10:00:00", "letter", "email", user_id="ann"),
                         ev("desk", "page_view", "2024-03-02 10:00:00", "x", "referral", user_id="ann"),
                         ev("desk", "purchase", "2024-03-03 10:00:00", revenue=10.0, session=2)])
    cfg = AttributionConfig(as_of="2024-04-01 00:00:00")
    stitched = stitch(raw, user_identity(raw))
    assert stitched.columns == raw.columns and stitched.schema == raw.schema
    channel = {n: Models(x, cfg).first_click.first().attributed_channel for n, x in (("apart", raw), ("one", stitched))}
    assert channel == {"apart": "Referral", "one": "Email"}
