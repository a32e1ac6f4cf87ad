"""Random racks and plain restatements of the rack rules for comparison."""

import math
import random
from collections import defaultdict

MULT = {1: 0.7, 2: 0.7, 3: 1.2, 4: 1.2, 5: 1.2, 6: 0.8, 7: 0.8}
SCHEMA = ("month_key string, rack_id string, product_id long, name string, category string, "
          "price_numeric double, profit_margin_percentage double, "
          "estimated_monthly_sales long, product_width_cm double, shelf_level int")


def random_rows(n_racks, sizes, seed=1, widths=(1, 60)):
    rng = random.Random(seed)
    rows, pid = [], 0
    for r in range(n_racks):
        for _ in range(rng.choice(sizes)):
            rows.append(("2025_01", f"R{r}", pid, f"P{pid}", "C",
                         round(rng.uniform(0.5, 9.5), 2), float(rng.randint(10, 60)),
                         rng.randint(1, 300), float(rng.randint(*widths)), rng.randint(1, 7)))
            pid += 1
    rng.shuffle(rows)
    return rows


def by_rack(rows):
    racks = defaultdict(list)
    for r in rows:
        racks[r[1]].append(dict(key=r[2], price=r[5], margin=r[6], sales=r[7], width=r[8],
                                shelf=r[9]))
    return racks


def value(p):
    return p["price"] * (p["margin"] / 100.0) * p["sales"]


def tier(price, shelf):
    if price > 5 and shelf in (3, 4, 5):
        return 1.1
    if price < 2 and shelf in (1, 2):
        return 1.15
    if price > 5 and shelf in (1, 2):
        return 0.85
    return 1.0


def profit(products):
    """Rack profit, product by product."""
    on = defaultdict(list)
    for p in products:
        on[p["shelf"]].append(p)
    total = 0.0
    for shelf, items in on.items():
        crowd = 1.0 if len(items) <= 5 else max(0.5, 1 - 0.05 * (len(items) - 5))
        fill = sum(p["width"] for p in items) / 300
        dim = max(0.7, 1 - 0.5 * (fill - 0.6)) if shelf in (3, 4, 5) and fill > 0.6 else 1.0
        total += sum(value(p) * MULT[shelf] * crowd * dim * tier(p["price"], shelf)
                     for p in items)
    return total * (1 + 0.15 * len(on) / 7)


def widths(products):
    used = {s: 0.0 for s in range(1, 8)}
    for p in products:
        used[p["shelf"]] += p["width"]
    return used


def repaired(products, worst_fit):
    products = [dict(p) for p in products]
    for shelf in range(1, 8):
        members = sorted((p for p in products if p["shelf"] == shelf),
                         key=lambda p: (-p["width"], p["key"]))
        for p in members:
            used = widths(products)
            if used[shelf] <= 300:
                break
            others = [s for s in range(1, 8) if s != shelf]
            if worst_fit:
                others = [min(others, key=lambda s: (used[s], s))]
            fits = [s for s in others if used[s] + p["width"] <= 300]
            if fits:
                p["shelf"] = fits[0]
    return {p["key"]: p["shelf"] for p in products}


def placed(products, choose):
    """Products by base profit; ``choose(product, room)`` gives the shelf."""
    room = {s: 300.0 for s in range(1, 8)}
    layout = {}
    for p in sorted(products, key=lambda p: (-value(p), p["key"])):
        shelf = choose(p, room)
        room[shelf] -= p["width"]
        layout[p["key"]] = shelf
    return layout


def greedy(products):
    def choose(p, room):
        better = [s for s in room if room[s] >= p["width"] and MULT[s] > MULT[p["shelf"]]]
        return min(better, key=lambda s: (-MULT[s], s)) if better else p["shelf"]
    return placed(products, choose)


def scored(products, scores):
    def choose(p, room):
        fits = [s for s in room if room[s] >= p["width"]]
        return max(fits, key=lambda s: (scores[p["key"]][s - 1], -s)) if fits else p["shelf"]
    return placed(products, choose)


def marginal(products):
    room = {s: 300.0 for s in range(1, 8)}
    context, layout = [], {}
    for p in sorted(products, key=lambda p: (-value(p), p["key"])):
        fits = [s for s in room if room[s] >= p["width"]]
        shelf = p["shelf"]
        if fits:
            shelf = max(fits, key=lambda s: (math.floor(profit([*context, dict(p, shelf=s)]) * 1e4 + 0.50001), -s))
            context.append(dict(p, shelf=shelf))
        room[shelf] -= p["width"]
        layout[p["key"]] = shelf
    return layout
