from .files import WRITERS, export, safe_name, slug, write_csv, write_geojson, write_jsonl, write_parquet, write_report

__all__ = ["WRITERS", "export", "safe_name", "slug", "write_csv", "write_geojson", "write_jsonl", "write_parquet", "write_report"]
