"""Sources and sinks: JSON-lines events, metric tables, warehouse mapping."""

from .batches import commit_batch, committed_batches, read_batches, write_batch
from .documents import first_documents, register_documents
from .jsonl import read_raw_events, split_malformed, write_jsonl
from .summary import Summary, read_summary, write_summarised
from .tables import read_table, reused, write_table
from .warehouse import load_table, raw_events, raw_events_from_tables

__all__ = [
    "Summary",
    "commit_batch",
    "committed_batches",
    "first_documents",
    "load_table",
    "raw_events",
    "raw_events_from_tables",
    "read_batches",
    "read_raw_events",
    "read_summary",
    "read_table",
    "register_documents",
    "reused",
    "split_malformed",
    "write_batch",
    "write_jsonl",
    "write_summarised",
    "write_table",
]
