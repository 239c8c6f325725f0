"""Sources and sinks: incident scan, CSV round trip, test-table adapter."""

from .adapter import incidents as adapter_incidents, read_table
from .csv import read_csv, write_csv
from .incidents import dataset_shape, not_null, read_incidents, scan_incidents

__all__ = ["adapter_incidents", "read_table", "read_csv", "write_csv",
           "dataset_shape", "not_null", "read_incidents", "scan_incidents"]
