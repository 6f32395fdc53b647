"""Incremental ingest of the landing zone with Structured Streaming."""

from ledgerline.streaming.landing_ingest import start_feed_ingest, run_feed_ingest_once

__all__ = ["start_feed_ingest", "run_feed_ingest_once"]
