"""DataFrame -> DataFrame operators: versions, pivot, companies, items,
metrics, joins and the upsert."""

from quillmart.operators.attributes import attribute_pivot
from quillmart.operators.companies import engaged_companies, lifecycle, qualifying_deals
from quillmart.operators.sync import apply_upsert, classify_changes, evolve_schema, values_equal
from quillmart.operators.versions import latest_version, version_rank

__all__ = [
    "attribute_pivot", "engaged_companies", "lifecycle", "qualifying_deals", "apply_upsert",
    "classify_changes", "evolve_schema", "values_equal", "latest_version", "version_rank",
]
