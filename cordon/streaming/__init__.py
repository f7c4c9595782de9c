"""Structured Streaming form of the audit: the same stateless operators on a stream of trip files, as runs of
the shared manifest or as mergeable per-batch partials of the zone-day rollup."""

from cordon.streaming.trips import read_raw_stream, start_ingest, start_zone_daily_partials  # noqa: F401
