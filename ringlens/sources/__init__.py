from ringlens.sources.readers import edge_rows, read_edge_file, read_headed_csv, read_positional_csv
from ringlens.sources.tables import load_table

__all__ = ["edge_rows", "load_table", "read_edge_file", "read_headed_csv", "read_positional_csv"]
