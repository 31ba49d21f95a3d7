"""Frame schemas and the graph contract's fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the graph contract.
CONTRACT_VERSION = "1.6"
NODE_PROPERTIES = {
    "Database": ("id", "name", "contract_version", "embedding"),
    "Schema": ("id", "name", "comment", "contract_version", "embedding"),
    "Table": ("id", "name", "catalog", "schema", "layer", "comment", "table_type", "created", "last_altered", "contract_version", "embedding"),
    "Column": ("id", "name", "catalog", "schema", "table", "data_type", "is_nullable", "ordinal_position", "comment", "contract_version", "embedding"),
    "Value": ("id", "value", "count", "catalog", "schema", "last_run", "contract_version", "embedding"),
}
EMBEDDING_TEXT = {
    "Table": "concat_ws(' | ', concat_ws('.', table_catalog, table_schema, name), nullif(trim(comment), ''))",
    "Column": "concat_ws(' | ', concat_ws('.', table_catalog, table_schema, table_name, name), data_type, nullif(trim(comment), ''))",
    "Schema": "concat_ws(' | ', concat_ws('.', catalog_name, name), nullif(trim(comment), ''))",
    "Database": "name",
    "Value": "value",
}
REL_TYPES = ("HAS_SCHEMA", "HAS_TABLE", "HAS_COLUMN", "HAS_VALUE", "REFERENCES")

SCHEMATA = "catalog_name string, schema_name string, comment string"
TABLES = "table_catalog string, table_schema string, table_name string, table_type string, comment string, created timestamp, last_altered timestamp"
COLUMNS = "table_catalog string, table_schema string, table_name string, column_name string, data_type string, is_nullable string, ordinal_position int, comment string"
CONSTRAINTS = "table_catalog string, table_schema string, table_name string, column_name string, constraint_type string, ordinal_position int, constraint_name string"
FK_PAIRS = "fk_schema string, fk_name string, src_catalog string, src_schema string, src_table string, src_column string, tgt_catalog string, tgt_schema string, tgt_table string, tgt_column string, ord int"
SAMPLED = "col_id string, col_name string, val string, cnt bigint, tbl_catalog string, tbl_schema string, tbl_name string"
LEDGER = "id string, embedding_text_hash string, embedding array<double>, embedding_model string, embedded_at timestamp"

REFERENCES = T.StructType(
    [
        T.StructField("source_id", T.StringType(), False),
        T.StructField("target_id", T.StringType(), False),
        T.StructField("confidence", T.DoubleType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("criteria", T.StringType(), True),
    ]
)

RUN_SUMMARY = (
    "run_id string, job_name string, contract_version string, catalog string, schemas array<string>, started_at timestamp, ended_at timestamp, status string, error string, "
    "row_counts map<string,bigint>, graph_counts map<string,bigint>, embedding_model string, embedding_flags map<string,boolean>, embedding_attempts map<string,bigint>, "
    "embedding_successes map<string,bigint>, embedding_failure_rate map<string,double>, embedding_failure_rate_all double, embedding_ledger_hits map<string,bigint>, "
    "verify_ok boolean, violations array<string>"
)
