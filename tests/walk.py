"""A plain per-event walk, written from the SCD2 rules, used as the test
oracle for every form of ``build_scd2``."""

KNOWN = ("added", "modified", "removed")


def walk(events, built_at="BUILT"):
    """events: dicts with key, ord (sortable), type, ts.  Returns dicts with
    key, ord, version, valid_from_ts, valid_to_ts, is_current, is_active,
    is_deleted, change_type."""
    out = []
    by_key = {}
    for e in events:
        by_key.setdefault(e["key"], []).append(e)
    for key, evs in by_key.items():
        evs = sorted(evs, key=lambda e: e["ord"])
        current = None
        for v, e in enumerate(evs, start=1):
            ts = e["ts"] or built_at
            ct = (e["type"] or "None").strip().lower()
            if current is not None:
                current["valid_to_ts"] = ts
                current["is_current"] = False
                current["is_active"] = False
            if ct not in KNOWN:
                continue
            row = {"key": key, "ord": e["ord"], "version": v, "valid_from_ts": ts,
                   "valid_to_ts": None, "is_current": True, "is_deleted": ct == "removed",
                   "is_active": ct != "removed", "change_type": ct}
            out.append(row)
            current = row
    return out
