"""S5 purchases: hand-made sequences, NULLs, ties and a brute-force property test."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from clickmart.operators import stage
from clickmart.operators.prefix import HOUR_US
from tests.conftest import at, frame, rows

PRODUCT, CONF = "/product_1", "/confirmation"


def feeds_from_sequence(spark, sessions: dict[str, str], step_minutes: float = 1):
    """sessions: id -> string of 'p'/'c', one click every ``step_minutes``."""
    b, l = [], []
    for sid, seq in sessions.items():
        for i, ch in enumerate(seq):
            eid = f"{sid}-{i:03d}"
            b.append({"event_id": eid, "click_id": sid, "event_timestamp": at(i * step_minutes)})
            l.append({"event_id": eid, "page_url_path": PRODUCT if ch == "p" else CONF})
    return frame(spark, "browser_events", b), frame(spark, "location_events", l)


@pytest.mark.parametrize("seq,expected", [
    ("c", [1]),
    ("ppc", [2]),
    ("ppcpc", [2, 1]),
    ("cpc", [1, 0]),
    ("pcc", [1, 0]),
])
def test_sequences(spark, seq, expected):
    b, l = feeds_from_sequence(spark, {"s1": seq})
    out = stage.purchases(b, l).orderBy("event_timestamp").collect()
    assert [r.product_count for r in out] == expected
    assert {r.session_id for r in out} == {"s1"}


def test_tied_product_not_counted(spark):
    b = frame(spark, "browser_events", [
        {"event_id": "e1", "click_id": "s", "event_timestamp": at(0)},
        {"event_id": "e2", "click_id": "s", "event_timestamp": at(0)}])
    l = frame(spark, "location_events", [
        {"event_id": "e1", "page_url_path": PRODUCT}, {"event_id": "e2", "page_url_path": CONF}])
    assert rows(stage.purchases(b, l), "product_count") == [(1,)]


def test_null_session_and_null_time(spark):
    b = frame(spark, "browser_events", [
        {"event_id": "p0", "click_id": None, "event_timestamp": at(0)},
        {"event_id": "c0", "click_id": None, "event_timestamp": at(1)},
        {"event_id": "p1", "click_id": "s", "event_timestamp": at(0)},
        {"event_id": "c1", "click_id": "s", "event_timestamp": None},
        {"event_id": "c2", "click_id": "s", "event_timestamp": at(5)}])
    l = frame(spark, "location_events", [
        {"event_id": e, "page_url_path": PRODUCT if e.startswith("p") else CONF}
        for e in ("p0", "c0", "p1", "c1", "c2")])
    got = rows(stage.purchases(b, l), "session_id", "event_timestamp", "product_count")
    assert got == sorted([(None, at(1), 1), ("s", None, 1), ("s", at(5), 1)],
                         key=lambda t: tuple((x is None, str(x)) for x in t))


def test_multiple_buckets(spark):
    """Clicks spread over several hours with one-hour buckets: the cross-bucket
    prefix must carry counts and maxima."""
    b, l = feeds_from_sequence(spark, {"s": "ppcpc"}, step_minutes=150)
    out = stage.purchases(b, l, bucket_us=HOUR_US).orderBy("event_timestamp").collect()
    assert [r.product_count for r in out] == [2, 1]


# ---- brute force -----------------------------------------------------------
def _like_product(p):
    return p is not None and len(p) >= 9 and p.startswith("/product")


def brute_force(browser, location):
    """Direct evaluation of the definition, row by row."""
    ev = [(bc, be, bt, lp) for (be, bc, bt) in browser for (le, lp) in location
          if be is not None and le is not None and be == le]
    conf = [e for e in ev if e[3] == CONF]
    prod = [e for e in ev if _like_product(e[3])]
    pc = defaultdict(int)
    for c, e, t, _ in conf:
        m = sum(1 for pc_, _, pt, _ in prod
                if c is not None and pc_ == c and t is not None and pt is not None and pt < t)
        pc[(e, t)] += max(m, 1)
    cum = [(c, t, v) for c, e, t, _ in conf for (e2, _t2), v in pc.items() if e2 == e]
    out = []
    for c, t, v in cum:
        prior = [v2 for c2, t2, v2 in cum
                 if c is not None and c2 == c and t is not None and t2 is not None and t2 < t]
        out.append((c, t, v - (max(prior) if prior else 0)))
    return sorted(out, key=lambda x: (x[0] is None, str(x[0]), x[1] is None, str(x[1]), x[2]))


def random_feeds(seed: int):
    r = random.Random(seed)
    sessions = ["s1", "s2", "s3", None]
    browser, location = [], []
    for i in range(60):
        eid = f"e{r.randrange(45)}"                      # duplicate ids on purpose
        t = None if r.random() < 0.05 else at(r.randrange(0, 600, 7) / 1.0)   # ties too
        browser.append((eid, r.choice(sessions), t))
    for i in range(50):
        eid = f"e{r.randrange(45)}"
        location.append((eid, r.choice([PRODUCT, "/products", CONF, CONF, "/home", "/product"])))
    return browser, location


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bucket_us", [HOUR_US, 24 * HOUR_US])
def test_matches_brute_force(spark, seed, bucket_us):
    browser, location = random_feeds(seed)
    b = frame(spark, "browser_events",
              [{"event_id": e, "click_id": c, "event_timestamp": t} for e, c, t in browser])
    l = frame(spark, "location_events", [{"event_id": e, "page_url_path": p} for e, p in location])
    got = [(r.session_id, r.event_timestamp, r.product_count)
           for r in stage.purchases(b, l, bucket_us=bucket_us).collect()]
    got.sort(key=lambda x: (x[0] is None, str(x[0]), x[1] is None, str(x[1]), x[2]))
    assert got == brute_force(browser, location)
