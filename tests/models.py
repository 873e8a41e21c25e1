"""Plain-Python models of the sequential rules, used as test oracles."""

from __future__ import annotations

from collections import defaultdict


def by_key(rows, key=0):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def arrival_mean(rows, width):
    """rows: (key, seq, ts, value). -> {(key, end): (n, mean)}"""
    res = {}
    for k, rs in by_key(rows).items():
        end = None
        for _, _, ts, v in sorted(rs, key=lambda r: r[1]):
            if end is not None and ts < end:
                tot, n = tot + v, n + 1
                continue
            if end is not None:
                res[(k, end)] = (n, tot / n)
            end, tot, n = ts - ts % width + width, v, 1
        res[(k, end)] = (n, tot / n)
    return res


def capped(rows, gap, mx, mode):
    """rows: (key, seq, ts). -> set of (key, start, end, n, tuple(ts), reason)"""
    out = set()
    for k, rs in by_key(rows).items():
        rs = sorted(rs, key=lambda r: (r[2], r[1]))
        start = last = None
        buf = []

        def close(nxt):
            if mode == "event_time" or nxt is None:
                inact = last + gap <= start + mx
            else:
                inact = nxt >= last + gap
            end = last + gap if inact else start + mx
            out.add((k, start, end, len(buf), tuple(sorted(buf)), "Inactivity" if inact else "Max"))

        for _, _, t in rs:
            if start is not None and (t >= last + gap or t > start + mx):
                close(t)
                start = None
            if start is None:
                start, buf = t, []
            buf.append(t)
            last = t
        close(None)
    return out


def terminated(rows, gap, terms):
    """rows: (key, seq, ts, type). -> set of (key, start, end, segment, tuple(types), closed_by)"""
    out = set()
    for k, rs in by_key(rows).items():
        rs = sorted(rs, key=lambda r: (r[2], r[1]))
        start = last = None
        seg, buf = 0, []
        for _, _, t, typ in rs:
            if start is not None and t - last > gap:
                if buf:
                    out.add((k, start, last + gap, seg, tuple(buf), "timeout"))
                start = None
            if start is None:
                start, seg, buf = t, 0, []
            buf.append(typ)
            last = t
            if typ in terms:
                out.add((k, start, t + gap, seg, tuple(buf), "terminator"))
                seg, buf = seg + 1, []
        if buf:
            out.add((k, start, last + gap, seg, tuple(buf), "timeout"))
    return out


def early(rows, width, n, include_final):
    """rows: (key, seq, ts). -> sorted list of (key, ws, count, pane)"""
    out = []
    groups = defaultdict(list)
    for k, s, t in rows:
        groups[(k, t - t % width)].append(s)
    for (k, ws), seqs in groups.items():
        for i, _ in enumerate(sorted(seqs), start=1):
            if i >= n:
                out.append((k, ws, i, "early"))
        if include_final:
            out.append((k, ws, len(seqs), "final"))
    return sorted(out)


def alerts(rows, thr, include_open):
    """rows: (key, seq, ts). -> sorted list of (key, last, alert, next)"""
    out = []
    for k, rs in by_key(rows).items():
        rs = sorted(rs, key=lambda r: (r[2], r[1]))
        for a, b in zip(rs, rs[1:] + [None]):
            nxt = None if b is None else b[2]
            if (nxt is not None and nxt - a[2] >= thr) or (nxt is None and include_open):
                out.append((k, a[2], a[2] + thr, nxt))
    return sorted(out)


def late(rows, delay, width):
    """rows: (key, seq, ts) in arrival order seq. -> {seq: (wm, is_late)}"""
    out, mx = {}, None
    for _, s, t in sorted(rows, key=lambda r: r[1]):
        wm = None if mx is None else mx - delay
        out[s] = (wm, wm is not None and t - t % width + width <= wm)
        mx = t if mx is None else max(mx, t)
    return out


def gap_sessions(rows, gap):
    """rows: (key, seq, ts). -> set of (key, start, end, n); breaks when ts - prev > gap."""
    out = set()
    for k, rs in by_key(rows).items():
        ts = sorted(r[2] for r in rs)
        start, last, n = ts[0], ts[0], 0
        for t in ts:
            if t - last > gap:
                out.add((k, start, last + gap, n))
                start, n = t, 0
            last, n = t, n + 1
        out.add((k, start, last + gap, n))
    return out
