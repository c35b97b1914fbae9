"""Small event fixtures and an independent, row-by-row reading of the definitions."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

BASE = datetime(2026, 1, 1, 10, 0)


def event(n=1, at=BASE, **changes):
    return {
        "schema_version": 1,
        "event_id": f"e{n:05d}",
        "event_time": at.isoformat() + "+00:00",
        "user_id": "u1",
        "session_id": "s1",
        "event_type": "view",
        "product_id": "P001",
        "product_name": "Thing",
        "category": "Home",
        "quantity": 1,
        "price_paise": 1000,
        **changes,
    }


def random_events(count, seed=7, step=1.0, users=6):
    rng = random.Random(seed)
    out = []
    for n in range(count):
        user = rng.randrange(users)
        product = rng.randrange(4)
        out.append(
            event(
                n,
                BASE + timedelta(seconds=n * step),
                user_id=f"u{user}",
                session_id=f"s{user}-{n // 400}",
                event_type=rng.choice(["view", "view", "view", "search", "cart", "purchase"]),
                product_id=f"P{product}",
                category=f"C{product % 2}",
                quantity=rng.randint(1, 3),
                price_paise=rng.randint(1, 500),
            )
        )
    return out


def raw_frame(spark, events, ingested_at=None):
    rows = []
    for n, item in enumerate(events):
        text = item if isinstance(item, str) or item is None else json.dumps(item)
        rows.append((text, "t", 0, n, ingested_at or BASE + timedelta(days=1)))
    return spark.createDataFrame(
        rows, "raw_json string, topic string, partition int, offset bigint, ingested_at timestamp"
    )


def moment(text):
    return datetime.fromisoformat(text).replace(tzinfo=None)


def windows_of(at, size, slide):
    epoch = int((at - datetime(1970, 1, 1)).total_seconds())
    newest = epoch // slide * slide
    return [newest - i * slide for i in range(size // slide)]


def brute_metrics(events, size=60, slide=60):
    """{(start, category, product): (events, purchases, revenue, views, carts, users)}"""
    groups = defaultdict(lambda: [0, 0, 0, 0, 0, set()])
    for e in {e["event_id"]: e for e in reversed(events)}.values():
        for start in windows_of(moment(e["event_time"]), size, slide):
            g = groups[start, e["category"], e["product_id"]]
            g[0] += 1
            g[5].add(e["user_id"])
            if e["event_type"] == "purchase":
                g[1] += 1
                g[2] += e["quantity"] * e["price_paise"]
            g[3] += e["event_type"] == "view"
            g[4] += e["event_type"] == "cart"
    return {key: (*g[:5], len(g[5])) for key, g in groups.items()}


def metric_dict(frame, users):
    rows = frame.collect()
    return {
        (int((r.window_start - datetime(1970, 1, 1)).total_seconds()), r.category, r.product_id): (
            r.events,
            r.purchases,
            r.revenue_paise,
            r.views,
            r.carts,
            *([r[users]] if users else []),
        )
        for r in rows
    }
