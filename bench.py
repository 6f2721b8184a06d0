"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from probes.queries import registered  # noqa: E402
from strata.session import local_session  # noqa: E402

HEADLINE = (
    "kpi_revenue_monthly", "kpi_collection_by_currency", "kpi_academic_by_department", "kpi_subscription_status",
    "kpi_sales_pipeline", "kpi_lead_funnel", "kpi_student_vs_external", "kpi_mrr_breakdown", "kpi_lead_by_source", "kpi_headline",
    "silver_university_enrollments", "silver_university_grades", "silver_billing_invoices", "silver_crm_activities",
    "gold_fact_enrollment", "gold_fact_payment", "uni_grade_chronology", "uni_weight_sums", "uni_status_score_association",
    "bil_subscription_overlaps", "bil_item_subscription_match", "bil_payment_share", "bil_payments_against_header",
    "bil_unit_price_against_catalogue", "crm_activity_pairs", "xdm_email_overlaps", "xdm_score_against_billing", "rel_foreign_keys",
    "profile_columns", "profile_numbers", "dq_silver_keys", "gate_silver_flags", "ins_category_mix", "ins_score_spread",
    "stat_spearman", "ranks_by_value",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("strata-bench", cores)
    known = registered()
    known["kpi_lead_funnel"](spark, folder).write.format("noop").mode("overwrite").save()  # warm the JVM
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
