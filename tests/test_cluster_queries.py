"""The cluster queries equal a plain loop over the points of each entity and zone."""

import math
from collections import defaultdict
from statistics import mean, median

import pytest
from conftest import DATA

from tracelake.plans import registry


def half_up(x, digits):
    return math.floor(x * 10**digits + 0.5) / 10**digits


def clusters(points, threshold):
    """Greedy clusters of sorted points: the nearest centroid within the threshold, then merges of the first near pair."""
    out = []
    centre = lambda c: (sum(p[0] for p in c) / len(c), sum(p[1] for p in c) / len(c))
    away = lambda a, b: math.hypot(a[0] - b[0], a[1] - b[1])
    for p in sorted(points):
        near = [(away(centre(c), p), k) for k, c in enumerate(out)]
        if near and min(near)[0] <= threshold + 1e-9:
            out[min(near)[1]].append(p)
        else:
            out.append([p])
    merged = True
    while merged:
        merged = False
        for a in range(len(out)):
            for b in range(a + 1, len(out)):
                if not merged and away(centre(out[a]), centre(out[b])) <= threshold + 1e-9:
                    out[a] += out.pop(b)
                    merged = True
                    break
            if merged:
                break
    return out


def spawns(rows, threshold, reduce, least, share, compact):
    by_zone = defaultdict(lambda: defaultdict(list))
    for entity, zone, x, y, session in rows:
        by_zone[entity, zone][half_up(x, 4), half_up(y, 4)].append(session)
    each = defaultdict(list)
    for (entity, zone), points in by_zone.items():
        for c in clusters(points, threshold):
            sessions = {s for p in c for s in points[p]}
            each[entity].append((zone, reduce([p[0] for p in c]), reduce([p[1] for p in c]), len(sessions), sum(len(points[p]) for p in c)))
    out = []
    for entity, own in each.items():
        top = max(o[3] for o in own)
        own = [o for o in own if o[3] >= least or o[3] >= top * share]
        for zone in {o[0] for o in own}:
            here = [o for o in own if o[0] == zone]
            if compact is not None and all(math.hypot(a[1] - b[1], a[2] - b[2]) <= compact for a in here for b in here):
                here = [(zone, mean(o[1] for o in here), mean(o[2] for o in here), max(o[3] for o in here), sum(o[4] for o in here))]
            out += [(entity, zone, half_up(o[1], 2), half_up(o[2], 2), o[3], o[4]) for o in here]
    return sorted(out)


@pytest.mark.parametrize("name,scale,options", [("cluster_spawns", 10, (0.5, median, 2, 0.05, None)), ("cluster_spawns_compact", 1, (0.5, mean, 1, 0.0, 2.0))])
def test_cluster_queries_equal_a_plain_loop(spark, name, scale, options):
    rows = [(r.label, r.vec_id % 3, r.embedding[0] * scale, r.embedding[1] * scale, r.vec_id % 40) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = sorted((r.entity, r.zone, r.x, r.y, r.sessions, r.n) for r in registry.queries()[name](spark, DATA).collect())
    want = spawns(rows, *options)
    assert [(g[0], g[1], g[4], g[5]) for g in got] == [(w[0], w[1], w[4], w[5]) for w in want]
    assert all(abs(g[2] - w[2]) < 0.011 and abs(g[3] - w[3]) < 0.011 for g, w in zip(got, want, strict=True))
