"""Polyphase resampling of sampled signals, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def design(up: int, down: int) -> np.ndarray:
    """Windowed-sinc low-pass filter: Kaiser window of beta 5, ten lobes of the larger rate on either side."""
    widest = max(up, down)
    half = 10 * widest
    n = np.arange(-half, half + 1)
    h = np.sinc(n / widest) / widest * np.kaiser(2 * half + 1, 5.0)
    return h / h.sum() * up


def resample(x: np.ndarray, source: int, target: int) -> np.ndarray:
    """``x`` at another rate: output sample m sums the filter's phase over its input neighbours."""
    g = gcd(source, target)
    up, down = target // g, source // g
    if up == down:
        return x.astype(float)
    h = design(up, down)
    half = len(h) // 2
    n_out = -(-len(x) * up // down)
    centre = np.arange(n_out) * down
    reach = half // up + 1
    near = centre[:, None] // up + np.arange(-reach, reach + 1)[None, :]
    tap = centre[:, None] - near * up + half
    ok = (near >= 0) & (near < len(x)) & (tap >= 0) & (tap < len(h))
    return np.where(ok, h[np.clip(tap, 0, len(h) - 1)] * x[np.clip(near, 0, len(x) - 1)], 0.0).sum(axis=1)


def resample_nan(x: np.ndarray, source: int, target: int, most: float = 0.01) -> np.ndarray:
    """As ``resample``, with NaN where more than ``most`` of a sample comes from missing ones."""
    missing = np.isnan(x)
    if not missing.any():
        return resample(x, source, target)
    out = resample(np.where(missing, 0.0, x), source, target)
    out[resample(missing.astype(float), source, target) > most] = np.nan
    return out


def resample_blocks(blocks: DataFrame, target: int, nan_aware: bool = True, samples: str = "samples", fs: str = "fs") -> DataFrame:
    """Blocks (one signal array a row) at ``target`` samples a second."""
    names = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, rate in zip(batch[samples], batch[fs].to_pylist()):
                if not x.is_valid or rate is None:
                    out.append(None)
                    continue
                v = np.array([np.nan if e is None else e for e in x.as_py()], dtype=float)
                out.append((resample_nan if nan_aware else resample)(v, rate, target).astype(np.float32) if len(v) else v.astype(np.float32))
            made = {samples: pa.array(out, pa.list_(pa.float32())), fs: pa.array([target] * batch.num_rows, pa.int32())}
            yield pa.RecordBatch.from_arrays([made.get(n, batch[n]) for n in names], names=names)

    kinds = dict(blocks.dtypes) | {samples: "array<float>", fs: "int"}
    return blocks.mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in names))
