"""The daily job: rebuild both marts and publish them.

Both marts are made from one pass over the wide item rows.  The adherence mart is the
item mart without the two brand names, made distinct.  Items, projects and people are
unique on their own, so rows can only become equal where two rows of a project's
companies differ in nothing but those names: the small company dimension marks one row
of each such group, and the adherence mart is the rows with that mark (or without a
company).  No wide row is made twice, tagged or compared.

The joined rows are written once, as Parquet in the shared scratch folder (computed
once, lineage cut, a lost executor costs a re-read), each mart is published from them
as a new version (``publish_mart``): readers keep the previous version until the new
one is complete.  The scratch folder goes when the job ends, and versions beyond those
to keep go once nobody can still be reading them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.operators.items import (
    COMPANY_COLUMNS,
    Params,
    Sources,
    company_dimension,
    company_representatives,
    item_core,
)
from quillmart.plans.marts import (
    ADHERENCE_MART_CLUSTER,
    ADHERENCE_MART_COLUMNS,
    BRAND_COLUMNS,
    ITEM_MART_CLUSTER,
    ITEM_MART_COLUMNS,
    MART_ROW,
    PARTITION_SOURCE,
    _metrics,
)
from quillmart.session import scratch_dir
from quillmart.sources.files import remove
from quillmart.sources.sink import publish_mart
from quillmart.sources.versions import SnapshotTable

ITEM_MART = "task"
ADHERENCE_MART = "task_project_adherence"
_MARK = "__adherence"


def both_mart_rows(src: Sources, p: Params) -> DataFrame:
    """Rows of the item mart (before metrics); ``_MARK`` is false in those that the adherence mart leaves out."""
    companies = company_representatives(company_dimension(src, p, COMPANY_COLUMNS), BRAND_COLUMNS, _MARK)
    return item_core(src, p, companies, src.workers)


def build_marts(spark: SparkSession, src: Sources, p: Params, out_dir: str,
                num_partitions: int | None = None, keep: int = 2,
                older_than: dt.timedelta = dt.timedelta(days=7)) -> dict[str, str]:
    """Publish both marts under ``out_dir`` (full refresh, new versions);
    returns name -> base path (read with ``read_mart``).

    Versions that ``keep`` newer ones follow go ``older_than`` after they were replaced.
    """
    path = scratch_dir(spark, "mart-rows")
    out = {ITEM_MART: f"{out_dir.rstrip('/')}/{ITEM_MART}",
           ADHERENCE_MART: f"{out_dir.rstrip('/')}/{ADHERENCE_MART}"}
    try:
        rows = both_mart_rows(src, p)
        rows.write.option("compression", "zstd").parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        item = _metrics(rows, p.as_of, ITEM_MART_COLUMNS)
        adherence = _metrics(rows.filter(F.coalesce(_MARK, F.lit(True))), p.as_of, ADHERENCE_MART_COLUMNS)
        publish_mart(item, out[ITEM_MART], PARTITION_SOURCE, ITEM_MART_CLUSTER, num_partitions, MART_ROW)
        publish_mart(adherence, out[ADHERENCE_MART], PARTITION_SOURCE, ADHERENCE_MART_CLUSTER, num_partitions, MART_ROW)
    finally:
        remove(spark, path)
    for base in out.values():
        SnapshotTable(spark, base).vacuum(keep, older_than)
    return out
