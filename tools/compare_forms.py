"""Time the rewritten operators against the original query forms, in Spark.

(a) attribute pivot: one scan + one aggregation vs one window + one join per attribute,
    and vs one shuffle shared by a window over (entity, attribute) and the aggregation
(b) engaged companies: semi-join vs outer joins + NOT NULL + DISTINCT
(c) item mart end to end, (d) upsert -- ours only.
Each form runs twice (noop sink); the warm run is reported.  Results must be
equal row sets, which is checked.  Usage: python tools/compare_forms.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quillmart.functions.scalars import full_name, url_id  # noqa: E402
from quillmart.operators.companies import current_companies  # noqa: E402
from quillmart.operators.staging import stage, version_order  # noqa: E402
from quillmart.plans.registry import QUERIES, _src  # noqa: E402
from quillmart.session import build_session  # noqa: E402


def timed(df) -> float:
    best = None
    for _ in range(2):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = time.perf_counter() - t0
    return round(best, 3)


def pivot_join_form(src, p):
    lay = p.layouts.field_value
    cfv = stage(src.field_value, lay)
    w = Window.partitionBy("task_id", "field_id").orderBy(*[F.col(c).desc_nulls_last()
                                                          for c in version_order(lay)])
    ranked = cfv.select("task_id", "field_id", "display_value", F.row_number().over(w).alias("rn"))
    ids = [a for a, _ in p.fields]
    out = cfv.filter(F.col("field_id").isin(ids)).select("task_id").distinct()
    for a, name in p.fields:
        one = ranked.filter((F.col("field_id") == a) & (F.col("rn") == 1)).select(
            F.col("task_id").alias(f"__t_{name}"), F.col("display_value").alias(name))
        out = out.join(one, F.col("task_id") == F.col(f"__t_{name}"), "left").drop(f"__t_{name}")
    return out


def pivot_window_form(src, p):
    lay = p.layouts.field_value
    cfv = stage(src.field_value, lay).filter(F.col("field_id").isin([a for a, _ in p.fields]))
    w = Window.partitionBy("task_id", "field_id").orderBy(*[F.col(c).desc_nulls_last() for c in version_order(lay)])
    ranked = cfv.repartition("task_id").withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    return ranked.groupBy("task_id").agg(*[F.max(F.when(F.col("field_id") == a, F.col("display_value"))).alias(name)
                                           for a, name in p.fields])


def engaged_outer_form(src, p):
    from quillmart.operators.companies import qualifying_deals
    deals = qualifying_deals(src.deal, p.stages, p.excluded_types).select(F.col("deal_id").alias("__d"))
    links = src.deal_company.select(F.col("company_id").alias("__c"), F.col("deal_id").alias("__l")).distinct()
    comp = current_companies(src.company, p.today_col())
    owners = src.owner.select("owner_id", full_name("first_name", "last_name").alias("n"))
    bd = owners.select(F.col("owner_id").alias("__bd"), F.col("n").alias("company_brand_director"))
    bm = owners.select(F.col("owner_id").alias("__bm"), F.col("n").alias("company_brand_manager"))
    return (comp.join(links, F.col("id") == F.col("__c"), "left")
            .join(deals, F.col("__l") == F.col("__d"), "left")
            .join(bd, F.col("property_brand_director") == F.col("__bd"), "left")
            .join(bm, F.col("property_brand_manager") == F.col("__bm"), "left")
            .filter(F.col("__d").isNotNull())
            .select(F.col("id").alias("company_id"), F.col("property_name").alias("company_name"),
                    F.col("property_asana_project").alias("asana_project_link"),
                    url_id("property_asana_project").alias("asana_project_id"),
                    F.col("property_client_status").alias("company_status"),
                    "company_brand_director", "company_brand_manager")
            .distinct())


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    _, src, p = _src(spark, sf)
    res = {}
    ours, theirs = QUERIES["attribute_pivot"](spark, sf), pivot_join_form(src, p)
    assert ours.exceptAll(theirs.select(*ours.columns)).count() == 0 and ours.count() == theirs.count()
    window = pivot_window_form(src, p)
    assert ours.exceptAll(window.select(*ours.columns)).count() == 0 and ours.count() == window.count()
    res["attribute_pivot"] = {"one_pass": timed(ours), "join_per_attribute": timed(theirs), "shared_window": timed(window)}
    ours, theirs = QUERIES["engaged_company"](spark, sf), engaged_outer_form(src, p)
    assert ours.exceptAll(theirs.select(*ours.columns)).count() == 0 and ours.count() == theirs.count()
    res["engaged_company"] = {"semi_join": timed(ours), "outer_join_distinct": timed(theirs)}
    res["item_mart"] = {"end_to_end": timed(QUERIES["item_mart"](spark, sf))}
    res["sync_upsert"] = {"apply": timed(QUERIES["sync_upsert"](spark, sf)),
                          "summary": {r.action: r.n for r in QUERIES["sync_summary"](spark, sf).collect()}}
    print(json.dumps({"sf_dir": sf, "seconds_warm": res}))
    spark.stop()


if __name__ == "__main__":
    main()
