"""Hand-written change records of the three tables."""

from __future__ import annotations

import json
from pathlib import Path

B = 1706000000000


def _user(id, name, email, at, op="c", created=None):
    return {
        "id": id,
        "name": name,
        "email": email,
        "created_at": B + (at if created is None else created),
        "updated_at": B + at,
        "__op": op,
        "__ts_ms": B + at,
    }


def _product(id, name, price, category, at):
    return {
        "id": id,
        "name": name,
        "price": price,
        "category": category,
        "created_at": B + at,
        "updated_at": B + at,
        "__op": "c",
        "__ts_ms": B + at,
    }


def _order(id, user_id, product_id, quantity, total, status, at):
    return {
        "id": id,
        "user_id": user_id,
        "product_id": product_id,
        "quantity": quantity,
        "total_amount": total,
        "status": status,
        "created_at": B + at,
        "updated_at": B + at,
        "__op": "c",
        "__ts_ms": B + at,
    }


# The sample feed of 17 changes.
FEED = {
    "users": [
        _user(1, "John Doe", "john@example.com", 0),
        _user(2, "Jane Smith", "jane@example.com", 1000),
        _user(3, "Bob Johnson", "bob@company.com", 2000),
        _user(4, "Alice Williams", "alice@test.com", 3000),
        _user(5, "Charlie Brown", "charlie@example.com", 4000),
        _user(1, "John Doe Updated", "john.updated@example.com", 8000, "u", created=0),
        _user(5, "Charlie Brown", "charlie@example.com", 9000, "d", created=4000),
    ],
    "products": [
        _product(1, "Laptop", 999.99, "Electronics", 0),
        _product(2, "Phone", 699.99, "Electronics", 1000),
        _product(3, "Desk", 299.99, "Furniture", 2000),
        _product(4, "Chair", 149.99, "Furniture", 3000),
        _product(5, "Headphones", 199.99, "Electronics", 4000),
    ],
    "orders": [
        _order(1, 1, 1, 1, 999.99, "completed", 3000),
        _order(2, 2, 2, 2, 1399.98, "pending", 4000),
        _order(3, 3, 3, 1, 299.99, "completed", 5000),
        _order(4, 1, 4, 2, 299.98, "shipped", 6000),
        _order(5, 4, 5, 1, 199.99, "completed", 7000),
    ],
}


def land(root: Path, table: str, name: str, records: list[dict | str]) -> None:
    """Write records as one JSON-lines file; strings go in as they are."""
    folder = Path(root) / table
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / name).write_text("\n".join(lines) + "\n")


def land_feed(root: Path) -> None:
    for table, records in FEED.items():
        land(root, table, "feed.json", records)


def envelopes(table: str, records: list[dict]) -> list[tuple]:
    """Flat records as topic messages: (topic, partition, offset, timestamp ms, value)."""
    out = []
    for offset, record in enumerate(records):
        image = {k: v for k, v in record.items() if not k.startswith("__")}
        op = record["__op"]
        value = {
            "before": image if op != "c" else None,
            "after": image if op != "d" else None,
            "op": op,
            "ts_ms": record["__ts_ms"],
            "source": {"db": "shop", "table": table},
        }
        out.append((f"cdc.{table}", 0, offset, record["__ts_ms"], json.dumps(value)))
    return out


def messages_frame(spark, rows):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ms bigint, value string")
    return frame.select(
        "topic",
        "partition",
        "offset",
        F.timestamp_millis("ms").alias("timestamp"),
        F.col("value").cast("binary").alias("value"),
    )
