"""lakenorm: date-partitioned JSON tables to normalised Parquet tables, on Spark.

Public entry points::

    from lakenorm import normalize, full_import, incremental_import, convert_database
"""

from .functions.schema import (is_flat, needs_recalc, schema_changes, schema_rows, unify_schemas,
                               unify_types)
from .operators.align import align, null_fill, union_by_name, witness_row
from .operators.fuse import fuse_arrays
from .operators.normalize import NormalizeOptions, case_merge, distinct_rows, normalize, normalized_schema
from .operators.unfold import explode_arrays, unfold, unfold_structs
from .plans.convert import convert_database, full_import, incremental_import, read_converted
from .session import build_session, configure

__all__ = [
    "NormalizeOptions", "align", "build_session", "case_merge", "configure", "convert_database",
    "distinct_rows", "explode_arrays", "full_import", "fuse_arrays", "incremental_import", "is_flat",
    "needs_recalc", "normalize", "normalized_schema", "null_fill", "read_converted", "schema_changes",
    "schema_rows", "unfold", "unfold_structs", "unify_schemas", "unify_types", "union_by_name", "witness_row",
]
