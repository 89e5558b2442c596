"""Windows of monitor signals against a plain assembly."""

import random

import numpy as np

from bedside.operators.resample import resample
from bedside.plans import monitors

SCHEMA = "entity_id string, block_ms long, file string, channel string, gain double, offset double, points double, min double, max double, samples array<float>"


def expected(rows, anchor, rates, length, least, clean):
    """Blocks by second, the last file's last; windows from the anchor's first block to its last."""
    held = {}
    for e, ms, _, c, gain, offset, points, low, high, raw in sorted(rows, key=lambda r: r[2]):
        if c not in rates or None in (gain, offset) or not points or len(raw) != points:
            continue
        x = (np.array(raw, np.float32) * gain + offset).astype(np.float32)
        bad = (np.array(raw) <= -32767) | (np.array(raw) >= 32767)
        if low is not None and high is not None:
            bad |= (x < low) | (x > high)
        x[bad] = np.nan
        held.setdefault(e, {}).setdefault(c, {})[ms] = x
    out = {}
    for e, channels in held.items():
        if anchor not in channels:
            continue
        first, last = min(channels[anchor]), max(channels[anchor])
        windows = {}
        for t in range(first, last + 1, length * 1000):
            made = []
            for c, (source, target) in rates.items():
                x = np.full(length * source, np.nan)
                present = np.zeros(length, bool)
                for i in range(length):
                    s = channels.get(c, {}).get(t + i * 1000)
                    if s is not None and len(s) == source and np.isnan(s).mean() < 0.5:
                        x[i * source : (i + 1) * source], present[i] = s, True
                y = x if source == target else resample(np.nan_to_num(x), source, target)
                y[np.repeat(~present, target)] = np.nan
                made.append((int(present.sum()), y))
            if made[list(rates).index(anchor)][0] >= least:
                windows[t] = made
        if sum(w[list(rates).index(anchor)][0] == length for w in windows.values()) >= clean:
            out |= {(e, t): w for t, w in windows.items()}
    return out


def test_monitor_windows(spark):
    rng = random.Random(5)
    rows = []
    for e, seconds, start in (("a", 150, 1_000_500), ("b", 60, -7_000), ("few", 4, 0), ("none", 9, 0)):
        for s in range(seconds):
            for c, n in (("P", 10), ("E", 30), ("X", 5)):
                if rng.random() < 0.04 or (e == "none" and c == "P"):
                    continue
                for file in ("f1", "f2") if rng.random() < 0.2 else ("f1",):
                    raw = [float(rng.choice([rng.randrange(-400, 400)] * 9 + [-32768])) for _ in range(n)]
                    if rng.random() < 0.05:
                        raw = [-32768.0] * (n - 2) + raw[:2]
                    ms = start + s * 1000 + (250 if rng.random() < 0.03 and s > 5 else 0)
                    points = float(n + (rng.random() < 0.03))
                    low = None if rng.random() < 0.2 else -3.005
                    rows.append((e, ms, file, c, 0.01, 0.5, points, low, 4.005, raw))
    rows.append(("a", 1_003_500, "f9", "P", None, 0.0, 10.0, None, None, [1.0] * 10))
    rows.append(("a", 1_004_500, "f9", "P", 1.0, 0.0, 4.0, None, None, [1.0] * 4))
    blocks = spark.createDataFrame(rows, SCHEMA).repartition(4)
    rates = {"P": (10, 4), "E": (30, 30)}
    want = expected(rows, "P", rates, 5, 2, 2)
    got = {(r.entity_id, r.time_ms): r for r in monitors.monitor_windows(blocks, "P", rates, 5, 2, 2).collect()}
    assert got.keys() == want.keys() and len(got) > 10
    for key, made in want.items():
        for c, (n, x) in zip(rates, made):
            assert got[key][f"coverage_{c}"] == n
            np.testing.assert_allclose(np.array(got[key][c], float), x, atol=1e-5)
