from gridmetrics.sinks.export import key_digests, key_json_changes, to_key_json
from gridmetrics.sinks.loads import FoldStore
from gridmetrics.sinks.runlog import append_run, append_runs, compact_runs, read_runs
from gridmetrics.sinks.writers import kept, materialised, write_csv, write_outputs

__all__ = [
    "FoldStore",
    "append_run",
    "append_runs",
    "compact_runs",
    "key_digests",
    "kept",
    "key_json_changes",
    "materialised",
    "read_runs",
    "to_key_json",
    "write_csv",
    "write_outputs",
]
