from riskflow.sources.events import PAYLOAD_CONTRACT, dead_letters, event_stream, good_events, parse_events
from riskflow.sources.files import (
    list_dirs,
    partition_path,
    path_exists,
    read_extract,
    read_header_csv,
    read_headerless_csv,
    read_partition,
    validate_source,
)
from riskflow.sources.graph import adapt_transactions, class_labels, load_labelled_graph

__all__ = [
    "PAYLOAD_CONTRACT",
    "parse_events",
    "good_events",
    "dead_letters",
    "event_stream",
    "validate_source",
    "read_extract",
    "read_partition",
    "read_headerless_csv",
    "read_header_csv",
    "partition_path",
    "path_exists",
    "list_dirs",
    "adapt_transactions",
    "class_labels",
    "load_labelled_graph",
]
