"""The trailing feature rules on arrays, for the rows of one account in order of arrival."""

import numpy as np
import pandas as pd

from ledgerpulse.schema import CAT_COLS, ENTROPY_COLS, EPS, FREQ_COLS, WINDOW_ROWS


def _frames(values: np.ndarray, filler, places: np.ndarray) -> np.ndarray:
    """One row per value of the last axis: the value (last column) and those before it in its window."""
    before = np.full((*values.shape[:-1], places.shape[1] - 1), filler, dtype=values.dtype)
    return np.concatenate([before, values], axis=-1)[..., places]


CHUNK = 20_000


def trailing_rows(seconds: np.ndarray, logs: np.ndarray, cats: list[np.ndarray],
                  hours: np.ndarray, window: int = WINDOW_ROWS) -> dict[str, np.ndarray]:
    """Feature columns for every row over its last ``window`` rows; earlier rows given first serve as context.

    Works through long histories in chunks that overlap by one window, to bound its arrays.
    """
    parts = []
    for start in range(0, len(seconds), CHUNK):
        context = min(start, window)
        at = slice(start - context, start + CHUNK)
        part = _trailing_block(seconds[at], logs[at], [c[at] for c in cats], hours[at], window)
        parts.append({name: values[context:] for name, values in part.items()})
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _trailing_block(seconds, logs, cats, hours, window: int) -> dict[str, np.ndarray]:
    n, places = len(seconds), np.arange(len(seconds))[:, None] + np.arange(window)
    size = np.minimum(np.arange(1, n + 1), window).astype(float)
    present = np.arange(window)[None, :] >= (window - size)[:, None]
    frame = np.where(present, _frames(logs, 0.0, places), 0.0)
    mean = frame.sum(axis=1) / size
    off = np.where(present, frame - mean[:, None], 0.0)
    std = np.sqrt((off ** 2).sum(axis=1) / size)
    gap = np.maximum(np.diff(seconds, prepend=seconds[:1]) / 3600.0, EPS)
    angle = 2 * np.pi * hours / 24.0
    out = {
        "LogAmount": logs, "AmountZScore": (logs - mean) / (std + EPS), "MovingAvg": mean,
        "MovingStd": std, "LogTimeDiff": np.where(np.arange(n) == 0, 0.0, np.log(gap)),
        "HourSin": np.sin(angle), "HourCos": np.cos(angle),
    }
    # all categories at once: most accounts have few rows, so the number of array calls counts
    codes = pd.factorize(np.concatenate(cats), use_na_sentinel=False)[0].astype(np.int64).reshape(len(cats), n)
    frames = _frames(codes, -1, places)
    equal = frames[..., :, None] == frames[..., None, :]
    count = np.where(present, (equal & present[:, None, :]).sum(axis=-1), 1)
    distinct = np.rint(np.where(present, 1.0 / count, 0.0).sum(axis=-1))
    raw = np.maximum(np.log(size) - np.where(present, np.log(count), 0.0).sum(axis=-1) / size, 0.0)
    share = count[..., -1] / size
    entropies = np.where(distinct > 1, raw / np.log(np.maximum(distinct, 2)), 0.0)
    out |= dict(zip(FREQ_COLS, share)) | dict(zip(ENTROPY_COLS, entropies))
    return out


def category_arrays(rows: pd.DataFrame) -> list[np.ndarray]:
    return [rows[c].to_numpy(dtype=object) for c in CAT_COLS]
