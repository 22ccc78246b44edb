import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="lakeledger-tests")
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def write_page(root, institution, item, n, run_id, run_ts, added=(), modified=(),
               removed=(), drop=(), **header):
    """A page file as the puller lands it: pretty-printed, one per file."""
    d = os.path.join(root, institution, item, "sync_pages")
    os.makedirs(d, exist_ok=True)
    page = {"run_id": run_id, "run_ts": run_ts, "mode": header.pop("mode", "backfill"),
            "institution": institution, "item_id": item,
            "plaid_env": header.pop("plaid_env", "sandbox"),
            "cursor_in": header.pop("cursor_in", ""),
            "cursor_out": header.pop("cursor_out", f"c{n}"),
            "has_more": header.pop("has_more", False),
            "added": list(added), "modified": list(modified), "removed": list(removed)}
    page.update(header)
    for k in drop:
        del page[k]
    path = os.path.join(d, f"page_{n:04d}_{run_id}.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(page, f, indent=2)
    return path


def tx(tid, **kw):
    t = {"transaction_id": tid, "account_id": "acc1", "amount": 12.5,
         "iso_currency_code": "USD", "date": "2026-01-10", "name": "Coffee",
         "merchant_name": "Cafe", "pending": False, "payment_channel": "in store",
         "personal_finance_category": {"primary": "FOOD", "detailed": "FOOD_COFFEE",
                                       "confidence_level": "HIGH"},
         "location": {"city": "Berlin", "region": "BE", "country": "DE"}}
    t.update(kw)
    return t
