from tessera.sources.tables import read_table, read_tables, register_catalog
from tessera.sources.columnar_json import read_columnar_json
from tessera.sources.lookup import read_lookup_csv
from tessera.sources.stage import write_table, read_stage_table

__all__ = ["read_table", "read_tables", "register_catalog", "read_columnar_json",
           "read_lookup_csv", "write_table", "read_stage_table"]
