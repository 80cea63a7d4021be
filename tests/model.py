"""The rules as a plain sequential program, to hold the Spark plans against."""

from __future__ import annotations

START = (0, 0)


def admit(events):
    """events: (ts, batch, stale) in arrival order -> list of statuses."""
    last_ts, last_batch = START
    out = []
    for ts, batch, stale in events:
        if stale:
            out.append("stale")
        elif batch == last_batch:
            out.append("duplicate_batch")
        elif ts < last_ts:
            out.append("late")
        else:
            out.append("accepted")
            last_ts, last_batch = ts, batch
    return out


def half_up(value, divisor):
    size = (abs(value) * 2 + divisor) // (divisor * 2)
    return size if value >= 0 else -size


def series(accepted, whole, days=30, cent=1):
    """accepted: (day, value) in arrival order -> the newest ``days`` values."""
    held, last = [], None
    for day, value in accepted:
        if last is None:
            held = [value] * days
        elif day == last:
            held[-1] = value
        else:
            gap, start = day - last, held[-1]
            rise = value - start
            for i in range(1, gap):
                if whole:
                    held.append(start + rise * i // gap)
                else:
                    held.append(start + i * half_up(rise, gap * cent) * cent)
            held.append(value)
            held = held[-days:]
        last = day
    return held


def runs(dates):
    """Running count of consecutive equal dates."""
    out, current, total = [], None, 0
    for date in dates:
        total = total + 1 if date == current else 1
        current = date
        out.append(total)
    return out
