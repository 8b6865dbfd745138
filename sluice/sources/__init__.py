from .csv import scan_csv
from .json import scan_json
from .listing import list_files
from .tables import table_records
from .workbook import scan_workbooks

__all__ = ["list_files", "scan_csv", "scan_json", "scan_workbooks", "table_records"]
