"""Table groups: how each source table is extracted and applied."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

PARTITION_KEYS = {"snapshots": "snapshot_date", "mutable_dims": "extract_date", "facts": "event_date", "events": "event_date"}


@dataclass(frozen=True)
class Table:
    name: str
    group: str
    keys: tuple[str, ...] = ()
    event_date: str | None = None
    changed: str | None = None
    created: str | None = None
    granularity: str = "date"
    lookback: int = 0
    strategy: str | None = None

    @property
    def partition_key(self) -> str:
        return PARTITION_KEYS[self.group]

    @property
    def apply(self) -> str:
        """snapshot_history, append_only or merge."""
        if self.strategy:
            return self.strategy
        if self.group == "snapshots":
            return "snapshot_history"
        return "append_only" if self.group == "facts" and self.lookback <= 0 else "merge"


#: The source's tables.
TABLES = {
    t.name: t
    for t in (
        *(Table(n, "snapshots") for n in ("stores", "zones", "product_categories", "order_statuses", "delivery_type", "delivery_costing", "assortment")),
        Table("clients", "mutable_dims", ("id",), changed="updated_at", created="registration_date"),
        Table("costing", "mutable_dims", ("product_id", "store_id", "valid_from"), changed="valid_to", created="valid_from"),
        Table("delivery_resource", "mutable_dims", ("id",), changed="updated_at", created="created_at"),
        Table("products", "mutable_dims", ("id", "valid_from"), changed="valid_to", created="valid_from"),
        Table("orders", "facts", ("id",), event_date="order_date"),
        Table("order_product", "facts", ("order_id", "product_id"), event_date="order_date"),
        Table("payments", "facts", ("order_id", "payment_date"), event_date="payment_date", lookback=5),
        Table("order_status_history", "events", ("order_id", "status_datetime"), event_date="status_datetime", lookback=2),
        Table("delivery_tracking", "events", ("order_id", "status_datetime"), event_date="status_datetime", lookback=2),
    )
}


def with_lookbacks(tables: Mapping[str, Table], by_group: Mapping[str, int]) -> dict[str, Table]:
    """The tables with lookbacks given for whole groups, which win over those of single tables; none below 0."""
    return {n: replace(t, lookback=max(int(by_group[t.group]), 0)) if t.group in by_group else t for n, t in tables.items()}


def from_documents(groups: list[dict], definitions: Mapping[str, object]) -> dict[str, Table]:
    """Tables from configuration documents: groups with their defaults, and the tables of each group."""
    defaults = {g["group"]: g for g in groups}
    if unknown := {*definitions} - {*defaults}:
        raise ValueError(f"no group {', '.join(sorted(unknown))}")
    out = {}
    for group, tables in definitions.items():
        for name, own in (tables.items() if isinstance(tables, Mapping) else ((t, {}) for t in tables)):
            out[name] = Table(
                name, group, tuple(own.get("merge_keys", ())), own.get("event_date_column"), own.get("watermark_column"), own.get("created_column"),
                own.get("cursor_granularity", "date"), int(own.get("lookback_days", defaults[group].get("lookback_days", 0))), own.get("bronze_strategy"),
            )
    return out
