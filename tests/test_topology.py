from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from meterflow.operators import topology

SCHEMA = (
    "msn string, ts string, us bigint, seq bigint, hierarchy_match boolean, feeder_name string, "
    "substation_name string, latitude double, longitude double")
SECOND = 1_000_000
START = 1704103200 * SECOND


def frame(spark, rows):
    return spark.createDataFrame(
        [(m, "t", us, seq, known, feeder, sub, lat, lon)
         for m, us, seq, known, feeder, sub, lat, lon in rows], SCHEMA)


def brute_force(rows):
    """Every unknown outage against every known outage before it."""
    found = {}
    for m, us, seq, known, *_, lat, lon in rows:
        if known:
            continue
        feeders = {}
        for km, kus, kseq, kknown, feeder, sub, klat, klon in sorted(rows, key=lambda r: (r[1], r[2])):
            if kknown and us - 300 * SECOND <= kus <= us and (kus, kseq) < (us, seq):
                entry = feeders.setdefault(feeder, {"sub": sub, "first": (kus, kseq), "at": {}})
                entry["at"].setdefault(km, (klat, klon))
        if not feeders:
            continue
        most = max(len(f["at"]) for f in feeders.values())
        scored = []
        for name, f in feeders.items():
            n = len(f["at"])
            clat = sum(a for a, _ in f["at"].values()) / n
            clon = sum(b for _, b in f["at"].values()) / n
            h = (math.sin(math.radians(clat - lat) / 2) ** 2 + math.cos(math.radians(lat))
                 * math.cos(math.radians(clat)) * math.sin(math.radians(clon - lon) / 2) ** 2)
            km_ = 2 * 6371.0088 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
            score = 0.7 * n / most + 0.3 * max(0.0, 1 - km_ / 20)
            scored.append((-round(score, 9), -n, f["first"], name, f["sub"]))
        for rank, (score, n, _, name, sub) in enumerate(sorted(scored), 1):
            found[seq, rank] = (name, -n, sub, -score)
    return found


def computed(spark, rows, **options):
    return {
        (r["seq"], r["candidate_rank"]):
            (r["feeder_name"], r["n"], r["substation_name"], round(r["score"], 9))
        for r in topology.candidates(frame(spark, rows), **options).collect()}


@pytest.mark.parametrize("seed, bucket_s, span_s", [(1, 60, 1500), (2, 300, 900), (3, 7, 40), (4, 60, 3)])
def test_sweep_equals_brute_force(spark, seed, bucket_s, span_s):
    rng = random.Random(seed)
    rows = []
    for seq in range(400):
        known = rng.random() < 0.7
        meter = 0 if rng.random() < 0.3 else rng.randrange(25)  # one meter dominates
        us = START + rng.randrange(span_s) * SECOND
        feeder = f"F{meter % 5}" if known else None
        rows.append((f"k{meter}" if known else f"u{meter}", us, seq, known, feeder,
                     f"S{seq % 3}" if seq % 4 else None,
                     28 + meter / 100 + seq % 7 / 1000, 77 + meter / 90))
    want = brute_force(rows)
    assert want and computed(spark, rows, bucket_us=bucket_s * SECOND) == want


def test_edges(spark):
    known = ("k", START, 1, True, "F", None, 28.0, 77.0)
    late = lambda seconds, seq=2: ("u", START + int(seconds * SECOND), seq, False, None, None, 28.0, 77.0)
    assert len(computed(spark, [known, late(300)])) == 1
    assert not computed(spark, [known, late(300.000001)])
    assert len(computed(spark, [known, late(0)])) == 1
    assert not computed(spark, [known, late(0, seq=0)])  # same time, arrived earlier
    twice = [known, ("k", START + SECOND, 2, True, "F", "S", 29.0, 78.0), late(5, 3)]
    assert computed(spark, twice) == {(3, 1): ("F", 1, None, 1.0)}


def test_result_records(spark):
    rows = [(f"k{i}", START, i, True, f"F{i}", None, 28.0 + i, 77.0) for i in range(5)]
    rows.append((" u ", START + 120 * SECOND, 9, False, None, None, 28.0, 77.0))
    got = topology.topology_results(frame(spark, rows)).orderBy("candidate_rank").collect()
    assert [r["candidate_rank"] for r in got] == [1, 2, 3]
    best, second = got[0], got[1]
    assert best["inference_id"] == " u :2024-01-01T10:02" and best["candidate_feeder"] == "F0"
    assert (best["topology_score"], best["confidence"], best["severity"]) == (1.0, 1.0, "INFO")
    assert best["candidate_substation"] == "" and best["recommendation"].startswith("Review feeder F0")
    assert second["proximity_score"] == 0.0 and second["topology_score"] == 0.7
    assert [r["candidate_feeder"] for r in got[1:]] == ["F1", "F2"]  # tie: first seen first


def test_relevance_does_not_trim(spark):
    rows = spark.createDataFrame(
        [(0, " m ", "2024-01-01 10:00:00", "Power failure", "occurrence"),
         (1, "m", " 2024-01-01 10:00:00", "Power failure", "OCCURRENCE"),
         (2, "m", "2024-01-01 10:00:00", "Power failure", "RESTORATION"),
         (3, " ", "2024-01-01 10:00:00", "Power failure", "OCCURRENCE")],
        "seq bigint, msn string, ts string, event_name string, event_state string")
    rows = rows.withColumns({
        "hierarchy_match": F.lit(True), "feeder_name": F.lit("F"), "substation_name": F.lit("S"),
        "latitude": F.lit(1.0), "longitude": F.lit(1.0)})
    assert [r["seq"] for r in topology.outage_occurrences(rows).collect()] == [0]


def test_work_grows_with_outages_times_feeders(spark):
    """Ten times the events over the same feeders and minutes give ten times the rows, not a hundred."""
    def asked(times):
        rows = []
        for n in range(40 * times):
            us = START + (n * 1_500_000) // times
            rows.append((f"k{n}", us, 2 * n, True, f"F{n % 4}", None, 28.0, 77.0))
            rows.append((f"u{n}", us + 1, 2 * n + 1, False, None, None, 28.0, 77.0))
        events = frame(spark, rows)
        steps = topology.evidence_steps(topology.known_evidence(events))
        return topology.asked_feeders(topology.unknown_outages(events), steps).count()
    assert asked(1) == 40 * 4 and asked(10) == 400 * 4


def test_outages_of_one_number_are_ranked_apart(spark):
    """Arrival numbers taken from the payload may repeat from meter to meter."""
    rows = [(f"k{i}", START, i, True, f"F{i}", None, 28.0 + i, 77.0) for i in range(3)]
    rows += [(m, START + SECOND, 9, False, None, None, 28.0 + at, 77.0) for m, at in (("u", 0), ("v", 2))]
    got = {(r["unknown_msn"], r["candidate_rank"]): r["candidate_feeder"]
           for r in topology.topology_results(frame(spark, rows)).collect()}
    assert got == {("u", 1): "F0", ("u", 2): "F1", ("u", 3): "F2",
                   ("v", 1): "F2", ("v", 2): "F0", ("v", 3): "F1"}


@pytest.mark.parametrize("seed, bucket_s, place", [
    (1, 60, (28.0, 77.0, 0.6)), (2, 7, (-89.7, 0.0, 0.5)), (3, 300, (0.0, 179.9, 0.4)), (4, 60, (51.0, 0.0, 20.0))])
def test_three_best_of_few_asked_are_those_of_all(spark, monkeypatch, seed, bucket_s, place):
    """Also around a pole and the date line, and where support decides."""
    monkeypatch.setattr(topology, "FEW_FEEDERS", 0)
    rng = random.Random(seed)
    lat, lon, spread = place
    rows = []
    for seq in range(900):
        known = rng.random() < 0.8
        meter = rng.randrange(400)
        feeder = int(rng.random() ** 2 * 60)
        at = (lat + spread * (feeder % 8) / 8 + rng.random() * 0.02, lon + spread * (feeder // 8) / 8 + rng.random() * 0.02)
        us = START + int(rng.random() * 420 * SECOND)
        rows.append((f"k{meter}" if known else f"u{seq}", us, seq, known, f"F{feeder}" if known else None, None,
                     at[0], at[1] if at[1] <= 180 else at[1] - 360))
    three = lambda every: {
        (r["msn"], r["seq"], r["candidate_rank"]): (r["feeder_name"], r["n"], round(r["score"], 9), round(r["cooccurrence"], 9))
        for r in topology.candidates(frame(spark, rows), bucket_s * SECOND, every).where("candidate_rank <= 3").collect()}
    want = three(True)
    assert len(want) > 300 and three(False) == want


def test_feeders_asked_do_not_grow_with_feeders(spark):
    def asked(feeders):
        rows = [(f"k{n}", START + n * 240 * SECOND // feeders, n, True, f"F{n}", None,
                 -60 + 120 * (n % 30) / 30, -170 + 340 * (n // 30) / (feeders / 30)) for n in range(feeders)]
        rows += [(f"u{n}", START + 241 * SECOND + n, feeders + n, False, None, None, 28.0, 77.0) for n in range(40)]
        events = frame(spark, rows)
        steps = topology.evidence_steps(topology.known_evidence(events))
        return topology.asked_feeders(topology.unknown_outages(events), steps, every=False).count() / 40
    assert asked(1800) <= 1.2 * asked(300) <= 50
