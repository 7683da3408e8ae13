"""Settings of the composite jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RetailConfig:
    """Table locations below ``warehouse`` and the fixed parameters of the jobs."""

    warehouse: str
    test_mode: bool = False

    # Default table names.
    clickstream_raw: str = "Retail_Store/raw_clickstream_data"
    clickstream_clean: str = "Retail_Store/clean_clickstream_data"
    clickstream_on_time: str = "Retail_Store/on_time_clickstream_data"
    clickstream_sessions: str = "Retail_Store/sessionized_clickstream"
    stock_raw: str = "Retail_Store/raw_inventory_data"
    stock_clean: str = "Retail_Store/clean_inventory_data"
    transactions_raw: str = "Retail_Store/raw_transactions_data"
    transactions_clean: str = "Retail_Store/clean_transaction_data"
    store_locations: str = "Retail_Store/Store_Locations"
    dead_letters: str = "Retail_Store/deadletter_data"
    metrics: str = "Retail_Store/parse_metrics"
    aggregates: str = "Retail_Store_Aggregations"
    stock_serving: str = "serving/stock"
    signal_serving: str = "serving/signal"

    clickstream_batch_file: str | None = None
    stock_batch_file: str | None = None
    transaction_batch_file: str | None = None

    window_ms: int = 5_000
    session_gap_ms: int = 30_000
    fast_threshold: int = 100
    refresh_seconds: int = 600
    watermark_ms: int = 600_000
    #: State of keys without sales for longer than this is dropped; None keeps it for ever. Beyond a day no signal changes.
    velocity_idle_ms: int | None = 2 * 86_400_000

    @property
    def watermark(self) -> str:
        return f"{self.watermark_ms} milliseconds"

    def table(self, name: str) -> str:
        """Full path of the table setting ``name``, e.g. ``cfg.table("dead_letters")``."""
        return f"{self.warehouse.rstrip('/')}/{getattr(self, name)}"

    def letters(self, feed: str) -> str:
        """Folder of one feed's dead letters; ``table("dead_letters")`` reads all feeds."""
        return f"{self.table('dead_letters')}/feed={feed}"
