"""How each source lands (S1): write mode, key, event time and file order.

A source with an event time is stored in day folders (DAY_COLUMN); a window
load replaces whole days of it. The others are one folder each.
"""

from __future__ import annotations

from typing import NamedTuple

DAY_COLUMN = "_partition_date"

# The write modes, and mode, key, event time and order of every source.
PARTITION_OVERWRITE = "partition_overwrite"
FULL_REPLACE = "full_replace"
MERGE_INSERT_ONLY = "merge_insert_only"


class Landing(NamedTuple):
    mode: str
    key: str = "id"
    event_time: str | None = None
    sorted_by: tuple[str, ...] = ()


LANDINGS: dict[str, Landing] = {
    "orders": Landing(PARTITION_OVERWRITE, "order_id", "created_at", ("user_id",)),
    "order_items": Landing(PARTITION_OVERWRITE, "id", "created_at", ("order_id", "product_id")),
    "events": Landing(PARTITION_OVERWRITE, "id", "created_at", ("user_id", "event_type")),
    "inventory_items": Landing(FULL_REPLACE),
    "users": Landing(FULL_REPLACE),
    "distribution_centers": Landing(FULL_REPLACE),
    "products": Landing(MERGE_INSERT_ONLY),
}
