"""Sources and sinks over any path that Spark's readers and writers open."""

from .files import batches_done, current, load_rules, materialize, quarantine_jsonl, read_csv, read_json_array, read_jsonl, read_many, read_pages, read_rules, read_table, refresh, rollback, scratch, snapshot, write

__all__ = ["batches_done", "current", "load_rules", "materialize", "quarantine_jsonl", "read_csv", "read_json_array", "read_jsonl", "read_many", "read_pages", "read_rules", "read_table", "refresh", "rollback", "scratch", "snapshot", "write"]
