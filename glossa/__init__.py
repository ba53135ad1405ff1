"""glossa: corpus analytics and annotation as Spark DataFrame jobs.

Every public operator takes and returns DataFrames (usable with
``df.transform(...)``) and is written with built-in Spark SQL expressions or
Spark ML, so Catalyst plans it and whole-stage codegen runs it.

Sub-packages
------------
functions   column expressions (patterns, flags, label names, formatting)
sources     corpus readers and writers (documents, TSV/JSON sinks, tokenizer and runs I/O)
operators   tokens, BPE, labels, entities, agreement, windows, n-gram model, tagger, sweep
plans       the registered queries (one per inventory ID) and their DuckDB oracle SQL
streaming   notes on streaming (the source project has no stream processing)
"""

from glossa.session import build_session, ensure_checkpoint_dir, read_table

__all__ = ["build_session", "ensure_checkpoint_dir", "read_table"]
