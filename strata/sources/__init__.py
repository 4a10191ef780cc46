from strata.sources.bucketed import Bucketed, join_bucketed, open_bucketed, store_bucketed
from strata.sources.landing import (
    Landing,
    bronze_frame,
    bronze_stream,
    discover,
    ingest,
    landing_stream,
    read_files,
)
from strata.sources.schemas import SchemaStore, merge_schemas
from strata.sources.tables import (
    create_layers,
    materialize_view,
    preview,
    register_table,
    replace_table,
    use_schema,
)

__all__ = [
    "Bucketed",
    "Landing",
    "SchemaStore",
    "bronze_frame",
    "bronze_stream",
    "create_layers",
    "discover",
    "ingest",
    "join_bucketed",
    "landing_stream",
    "materialize_view",
    "merge_schemas",
    "open_bucketed",
    "preview",
    "read_files",
    "register_table",
    "replace_table",
    "store_bucketed",
    "use_schema",
]
