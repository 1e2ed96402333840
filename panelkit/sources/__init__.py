from panelkit.sources.audit import audit_source, latest_audit, write_with_audit
from panelkit.sources.csv import read_csv, read_parquet_or_csv, write_csv
from panelkit.sources.tables import write_feature_panel

__all__ = [
    "audit_source",
    "latest_audit",
    "read_csv",
    "read_parquet_or_csv",
    "write_csv",
    "write_feature_panel",
    "write_with_audit",
]
