"""Plain sequential versions of the keyed rules, used as the test oracle."""

from collections import defaultdict


def inventory_fold(rows):
    """rows: dicts in arrival order. Returns (emitted, dropped) as lists of (row, value)."""
    state, emitted, dropped = {}, [], []
    for row in rows:
        key = (row["store_id"], row["product_id"])
        reset, count = state.get(key, (None, 0))
        kind, quantity, time = row["event_type"], row["quantity"], row["timestamp"]
        if kind == "RESET":
            state[key] = (time, quantity)
            emitted.append((row, quantity))
            continue
        if reset is not None and time < reset:
            dropped.append((row, reset))
            continue
        sign = {"SALE": -1, "SHIPMENT": -1, "RECEIPT": 1, "RETURN": 1}.get(kind)
        if sign is None:
            continue
        count += sign * quantity
        state[key] = (reset, count)
        emitted.append((row, count))
    return emitted, dropped


def velocity_fold(rows, threshold):
    newest, buckets, out = {}, defaultdict(dict), []
    for row in rows:
        if row["event_type"] != "SALE":
            continue
        key = (row["store_id"], row["product_id"])
        newest[key] = max(newest.get(key, row["timestamp"]), row["timestamp"])
        minute = row["timestamp"] // 60000
        mine = buckets[key]
        mine[minute] = mine.get(minute, 0) + abs(row["quantity"])
        ref = newest[key] // 60000
        hour = sum(q for m, q in mine.items() if m > ref - 60)
        day = sum(q for m, q in mine.items() if m > ref - 1440)
        for m in [m for m in mine if m <= ref - 1440]:
            del mine[m]
        out.append((row, ("FAST", "1h", hour) if hour >= threshold else ("SLOW", "24h", day)))
    return out
