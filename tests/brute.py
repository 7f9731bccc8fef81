"""The weekly run over Python rows, step by step, for small random inputs."""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict

NEAR = {"L1", "L2", "Z1", "Z2"}
CAUSES = ["forecast", "ndoh", "ipc_override", "cdo_override", "po", "vendor_adherence"]


def week(d):
    return (d.timetuple().tm_yday - 1) // 7 + 1


def detail(t, ws, we):
    """Losses per (product, destination) from dict-of-lists tables."""
    sales = [s for s in t["sales_raw"] if s["week"] == week(we) and s["fsn"]]
    lanes = [x for x in t["lzn_mapping"] if x["lzn_value"] not in ("", "0", "NULL", None)]
    near = {(x["dest_pincode"], x["src_fc_code"]) for x in lanes if x["lzn_value"] in NEAR}
    category = {(s["fsn"], s["category"]) for s in sales}
    nat, sold, brands = defaultdict(float), defaultdict(float), defaultdict(set)
    for s in sales:
        key = s["fsn"], s["destination_pincode"]
        nat[key] += s["nat_sales"]
        sold[key] += s["sales"]
        brands[key].add((s["brand"], s["vertical"]))

    vsids = defaultdict(set)
    for v in t["vendor_site"]:
        vsids["p", v["fsn"], v["fc"]].add(v["vsid"])
    for v in t["vendor_brand"]:
        vsids["b", v["brand"], v["vertical"], v["fc"]].add(v["vsid"])
    fcs = {
        (p, d): sorted(
            f
            for dd, f in near
            if dd == d
            and (vsids.get(("p", p, f)) or any(vsids.get(("b", *bv, f)) for bv in brands[p, d]))
        )
        for p, d in nat
    }

    threshold = {x["category"]: x["min_sales_depth"] for x in t["min_sale_threshold"]}
    history = defaultdict(float)
    for s in t["sales_raw"]:
        if ws - dt.timedelta(28) <= s["day"] < ws:
            history[s["fsn"], s["category"]] += s["sales"]
    low = {p for (p, c), v in history.items() if v <= threshold.get(c, 0)}
    excluded = {
        x["fsn"] for x in t["exclusion_list"] if dt.date.fromisoformat(x["skip_upto"]) >= ws
    }

    out = {}
    for p, d in nat:
        losses = dict.fromkeys(["serviceability", "vendor", "low_sale_depth", "exclusion"], 0.0)
        if not any(dd == d for dd, _ in near):
            losses["serviceability"] = nat[p, d]
        elif not fcs[p, d]:
            losses["vendor"] = nat[p, d]
        elif p in low:
            losses["low_sale_depth"] = nat[p, d]
        elif p in excluded:
            losses["exclusion"] = nat[p, d]
        out[p, d] = losses

    # issues
    offers = [
        e for e in t["explain"] if week(dt.datetime.strptime(str(e["day"]), "%Y%m%d")) == week(we)
    ]
    national = {
        e["fiu_id"]
        for e in offers
        if e["lzn_value"] in ("N1", "N2") and e["is_accepted"] in ("true", "TRUE", "1")
    }
    fe = defaultdict(set)
    for e in offers:
        if e["lzn_value"] in NEAR and e["effective_inventory"] > 0 and e["fiu_id"] in national:
            fe[e["fsn"], e["destination_pincode"]].add(e["fiu_id"])

    cat_lead = {x["category"]: x["lead_time"] for x in t["cat_lead_time"]}
    longest = {}
    for p, c in category:
        if cat_lead.get(c) is not None:
            longest[p] = max(longest.get(p, 0.0), cat_lead[c])
    lead = {}
    for x in t["lead_time"]:
        if any(p == x["fsn"] for p, _ in category):
            days = x["lead_time"]
            lead[x["fsn"], x["warehouse"]] = longest.get(x["fsn"]) if days < 1 else days

    def number(x):
        try:
            return float(x)
        except (TypeError, ValueError):
            return 0.0

    issue = defaultdict(lambda: defaultdict(float))
    forecast = defaultdict(float)
    for r in t["requirement"]:
        key = r["fsn"], r["warehouse"]
        days = lead.get(key)
        if days is None or week(ws - dt.timedelta(math.ceil(days))) != r["week"]:
            continue
        names = ["forecast_n"] + [f"forecast_n{k}" for k in range(1, 8)]
        values = [number(r[n]) for n in names]
        k = math.ceil(days / 7)
        forecast[key] += values[k - 1] if 1 <= k <= 8 else sum(values) / 8
        steps = ["system", "max_doh", "ipc_reviewed", "cdo_reviewed", "po"]
        q = [number(r[f"{s}_qty"]) for s in steps]
        for cause, a, b in zip(CAUSES[1:5], q, q[1:]):
            issue[key][cause] += max(a - b, 0)

    preferred = {}
    for x in t["preferred_warehouse"]:
        value = x["preferred_fc_non_large"]
        preferred[x["pincode"]] = None if value is None else value.rpartition(",")[0].split(",")[0]
    at_preferred = defaultdict(float)
    for (p, d), units in sold.items():
        at_preferred[p, preferred.get(d)] += units
    for key, units in at_preferred.items():
        issue[key]["forecast"] = max(units - forecast.get(key, 0.0), 0)

    for v in t["vendor_adherence"]:
        for p in {p for p, _ in category if p == v["fsn"]}:
            days = lead.get((p, v["fc"]))
            days = longest.get(p) if days is None else days
            created = dt.datetime.strptime(str(v["poi_created_day"]), "%Y%m%d").date()
            if days is None:
                continue
            late_open = v["po_status"] == "approved" and (we - created).days - 7 >= days
            late_closed = v["po_status"] == "completed" and (ws - created).days <= 2 * days
            if late_open or late_closed:
                short = float(v["poi_ordered_qty"]) - float(v["poi_received_qty"])
                issue[p, v["fc"]]["vendor_adherence"] += max(short, 0)

    offered = defaultdict(float)
    for o in t["offer_sales"]:
        if o["week_num"] == week(we):
            offered[o["fsn"], o["dest_pincode"]] += o["offer_sales"]

    for key, losses in out.items():
        losses.update(dict.fromkeys(["fe", *CAUSES, "promotions", "residual"], 0.0))
        if any(losses[c] > 0 for c in ("serviceability", "vendor", "low_sale_depth", "exclusion")):
            pool = 0.0
        else:
            losses["fe"] = min(len(fe.get(key, ())), nat[key])
            pool = nat[key] - losses["fe"]
        for f in fcs[key]:
            left = pool / len(fcs[key])
            for cause in CAUSES:
                take = min(left, issue[key[0], f][cause])
                losses[cause] += take
                left -= take
            losses["residual"] += left
        losses["promotions"] = max(losses["residual"] - offered.get(key, 0.0), 0.0)
        losses["residual"] -= losses["promotions"]
    return out
