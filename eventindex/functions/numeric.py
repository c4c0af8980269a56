"""Arrow UDFs for what built-in functions cannot express at array speed: median filter, FFT."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

NUMBERS = T.ArrayType(T.DoubleType())


def _medians(frame: np.ndarray) -> np.ndarray:
    """3x3 median with zeros outside. The three values of every column segment are sorted once
    and shared by the windows that overlap it."""
    p = np.pad(frame, 1)
    top, mid, low = p[:-2], p[1:-1], p[2:]
    small, large = np.minimum(top, mid), np.maximum(top, mid)
    lo, hi = np.minimum(small, low), np.maximum(large, low)
    med = np.maximum(small, np.minimum(large, low))

    def median(a, b, c):
        return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))

    lows = np.maximum(np.maximum(lo[:, :-2], lo[:, 1:-1]), lo[:, 2:])
    highs = np.minimum(np.minimum(hi[:, :-2], hi[:, 1:-1]), hi[:, 2:])
    return median(lows, median(med[:, :-2], med[:, 1:-1], med[:, 2:]), highs)


def _as_frame(data, width, height):
    if data is None or pd.isna(width) or pd.isna(height):
        return None
    w, h = int(width), int(height)
    if w < 1 or h < 1 or len(data) != w * h:
        return None
    return np.asarray(data, dtype=np.float64).reshape(h, w)


@F.pandas_udf(NUMBERS)
def median3x3(data: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    frames = (_as_frame(*row) for row in zip(data, width, height))
    return pd.Series([None if f is None else _medians(f).ravel() for f in frames], dtype=object)


@F.pandas_udf(NUMBERS)
def spectrum(signal: pd.Series, bins: pd.Series) -> pd.Series:
    """Amplitudes of the first `bins` Fourier components."""
    return pd.Series([None if x is None or len(x) == 0
                      else np.abs(np.fft.fft(np.asarray(x, dtype=np.float64)))[:int(n)]
                      for x, n in zip(signal, bins)], dtype=object)


@F.pandas_udf(NUMBERS)
def projection_spectrum(data: pd.Series, width: pd.Series, height: pd.Series, bins: pd.Series
                        ) -> pd.Series:
    """Amplitudes of the first `bins` Fourier components of a frame's row means, taken about
    their own mean."""
    out = []
    for values, w, h, n in zip(data, width, height, bins):
        frame = _as_frame(values, w, h)
        if frame is None:
            out.append(None)
            continue
        rows = frame.mean(axis=1)
        out.append(np.abs(np.fft.fft(rows - rows.mean()))[:int(n)])
    return pd.Series(out, dtype=object)


@F.pandas_udf(NUMBERS)
def column_peaks(data: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Largest Fourier amplitude of every frame column. A real signal's spectrum is symmetric,
    so the half spectrum holds the maximum."""
    frames = (_as_frame(*row) for row in zip(data, width, height))
    return pd.Series([None if f is None else np.abs(np.fft.rfft(f, axis=0)).max(axis=0)
                      for f in frames], dtype=object)
