from tidemark.sources.files import (
    burnt_trees, numbered_lines, read_anchors, read_chain_log, read_fasta, read_patterns, read_records, read_rules, read_table_text, read_text_columns, read_trees, states_from_labels, write_chain_log, write_fasta, write_table_text,
)
from tidemark.sources.tables import read_table

__all__ = ["burnt_trees", "numbered_lines", "read_anchors", "read_chain_log", "read_fasta", "read_patterns", "read_records", "read_rules", "read_table", "read_table_text", "read_text_columns", "read_trees", "states_from_labels", "write_chain_log", "write_fasta", "write_table_text"]
