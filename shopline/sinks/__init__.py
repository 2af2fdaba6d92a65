"""Writers: Parquet tables, JDBC tables and audit JSON (SNK1-5)."""

from shopline.sinks.writers import write_audit_json, write_jdbc, write_parquet

__all__ = ["write_audit_json", "write_jdbc", "write_parquet"]
