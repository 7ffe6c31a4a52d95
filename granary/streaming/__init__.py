"""Micro-batch ingest: keyed state of its own, and merges with the batch operators."""

from .ingest import append_changes, changed_within, fingerprint_changes, latest, merge_batch, merge_stream, snapshot_stream

__all__ = ["append_changes", "changed_within", "fingerprint_changes", "latest", "merge_batch", "merge_stream", "snapshot_stream"]
