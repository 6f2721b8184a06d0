"""Sales checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.catalog import CLOSED_STAGES, OPEN_STAGES
from strata.functions.dates import midnight
from strata.operators.dedupe import duplicate_counts
from strata.operators.lookup import condense, missing_children, weighted_if
from strata.operators.quantiles import exact_quantiles
from strata.operators.stats import cramers_v, decile_association, pearson, share_match, spearman
from strata.plans.audits.billing import _n, _with_scalars
from strata.plans.audits.university import Tables, day
from strata.session import stage


def account_names(t: Tables, as_of: str) -> DataFrame:
    a = t["crm_accounts"]
    names = a.groupBy("name").agg(_n().alias("n"))
    base = names.agg(
        F.count("name").alias("unique_names"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_with_shared_name"))
    pairs = duplicate_counts(a.where("name is not null and country is not null"), ["name", "country"], "name_country_")
    return _with_scalars(base, pairs.select("name_country_duplicate_groups", "name_country_rows_in_duplicate_groups"))


def top_account_names(t: Tables, as_of: str) -> DataFrame:
    return t["crm_accounts"].groupBy("name").agg(_n().alias("accounts")).orderBy(F.desc("accounts"), "name").limit(3)


def account_size(t: Tables, as_of: str) -> DataFrame:
    a = t["crm_accounts"]
    base = a.agg(
        F.count_if(F.col("employees") <= 0).alias("nonpositive_employees"),
        F.count_if(F.col("annual_revenue") <= 0).alias("nonpositive_revenue"),
        pearson(F.col("annual_revenue"), F.col("employees")).alias("pearson"))
    return _with_scalars(base, spearman(a, "annual_revenue", "employees"))


def contact_rules(t: Tables, as_of: str) -> DataFrame:
    c = t["crm_contacts"]
    accounts = t["crm_accounts"].select("account_id", F.col("created_at").alias("account_created_at"))
    early = condense(c, ["account_id", "created_at"]).join(accounts, "account_id").agg(
        weighted_if(F.col("created_at") < F.col("account_created_at")).alias("created_before_account"))
    emails = duplicate_counts(c.select(F.lower("email").alias("e")), ["e"], "e_")
    phones = duplicate_counts(c, ["phone"], "p_")
    return early.select(
        "*", F.lit(emails.select("e_rows_in_duplicate_groups").scalar()).alias("rows_in_shared_email"),
        F.lit(phones.select("p_rows_in_duplicate_groups").scalar()).alias("rows_in_shared_phone"))


def lead_scores_by_status(t: Tables, as_of: str) -> DataFrame:
    """Scores are small whole numbers, so quantile buffers stay small."""
    return t["crm_leads"].groupBy("status").agg(
        _n().alias("leads"), F.round(F.avg("score"), 2).alias("score_mean"),
        F.round(F.percentile("score", 0.5), 2).alias("score_median"))


def lead_score_association(t: Tables, as_of: str) -> DataFrame:
    return decile_association(t["crm_leads"], "status", "score", "cramers_v")


def lead_conversion(t: Tables, as_of: str) -> DataFrame:
    """A lead without a score counts with the high band, because that band is the complement of the low one."""
    leads = t["crm_leads"]
    won = F.col("status") == "converted"
    low = F.coalesce(F.col("score") < 50, F.lit(False))
    top = F.lit(leads.agg(F.percentile("score", 0.9)).scalar())
    return leads.agg(
        F.count_if(won).alias("converted"), F.count_if(low).alias("below_50"), F.count_if(low & won).alias("below_50_converted"),
        F.count_if(~low).alias("from_50"), F.count_if(~low & won).alias("from_50_converted"),
        F.count_if(won & (F.col("score") >= top)).alias("converted_in_top_decile"))


def _deals(t: Tables) -> DataFrame:
    accounts = t["crm_accounts"].select("account_id", F.col("created_at").alias("account_created_at"), "annual_revenue")
    return t["crm_opportunities"].join(accounts, "account_id")


def deal_chronology(t: Tables, as_of: str) -> DataFrame:
    close, made = F.col("close_date"), F.col("created_at")
    accounts = t["crm_accounts"].select("account_id", F.col("created_at").alias("account_created_at"))
    rows = condense(t["crm_opportunities"], ["account_id", "stage", "close_date", "created_at"]).join(
        accounts, "account_id", "left")
    return rows.agg(
        weighted_if(made < F.col("account_created_at")).alias("created_before_account"),
        weighted_if(midnight(close) < made).alias("close_before_created"),
        weighted_if(F.col("stage").isin(*OPEN_STAGES) & (close <= day(as_of))).alias("open_with_past_close"),
        weighted_if(F.col("stage").isin(*CLOSED_STAGES) & (close > day(as_of))).alias("closed_with_future_close"))


def close_before_created_by_stage(t: Tables, as_of: str) -> DataFrame:
    late = midnight(F.col("close_date")) < F.col("created_at")
    return t["crm_opportunities"].groupBy("stage").agg(F.count_if(late).alias("close_before_created"))


def deal_amount_against_revenue(t: Tables, as_of: str) -> DataFrame:
    rows = _deals(t)
    more = F.col("amount") > F.col("annual_revenue")
    base = rows.agg(
        F.count_if(more).alias("greater_than_revenue"), F.count_if(more & (F.col("stage") == "won")).alias("won_greater_than_revenue"),
        pearson(F.col("amount"), F.col("annual_revenue")).alias("pearson"))
    return _with_scalars(base, spearman(rows, "amount", "annual_revenue"))


def stage_summary(t: Tables, as_of: str) -> DataFrame:
    o = t["crm_opportunities"]
    base = o.groupBy("stage").agg(
        _n().alias("opportunities"), F.sum("amount").alias("amount_sum"),
        F.count_if(midnight(F.col("close_date")) < F.col("created_at")).alias("close_before_created"))
    return base.join(exact_quantiles(o, "amount", [0.5], ["amount_median"], ["stage"], digits=2), "stage", "left")


def stage_amount_association(t: Tables, as_of: str) -> DataFrame:
    return decile_association(t["crm_opportunities"], "stage", "amount", "cramers_v")


def _pairs_with_accounts(pairs: DataFrame, t: Tables, how: str = "inner") -> DataFrame:
    deals = t["crm_opportunities"].select("opportunity_id", F.col("account_id").alias("deal_account"))
    people = t["crm_contacts"].select("contact_id", F.col("account_id").alias("person_account"))
    return pairs.join(deals, "opportunity_id", how).join(people, "contact_id", how)


def bridge(t: Tables, as_of: str) -> DataFrame:
    pairs = condense(t["crm_opportunity_contacts"], ["opportunity_id", "contact_id"])
    # Pairs without a deal or a person stay in the join, where they agree with nobody, so that both counts are of the same rows: these are shuffled once.
    agree = _pairs_with_accounts(pairs, t, "left").agg(weighted_if(F.col("deal_account") == F.col("person_account")).alias("same_account"))
    counted = stage(pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_pairs"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_pairs"),
    ).unionByName(agree, allowMissingColumns=True))
    expected = stage(share_match(t["crm_opportunities"], "account_id", t["crm_contacts"], "account_id"))
    return counted.agg(*[F.sum(c).alias(c) for c in ("total_pairs", "duplicate_pairs", "same_account")]).select(
        "*", F.round(F.col("total_pairs") * F.lit(expected.scalar()), 2).alias("expected_same_account"))


def scope(contact: Column, deal: Column) -> Column:
    return (
        F.when(contact.isNotNull() & deal.isNotNull(), "both").when(contact.isNotNull(), "contact_only")
        .when(deal.isNotNull(), "opportunity_only").otherwise("unlinked")
    )


def _scoped(t: Tables) -> DataFrame:
    return t["crm_activities"].withColumn("scope", scope(F.col("contact_id"), F.col("opportunity_id")))


def activity_scope(t: Tables, as_of: str) -> DataFrame:
    return _scoped(t).groupBy("scope").agg(_n().alias("activities"))


def activity_pairs(t: Tables, as_of: str) -> DataFrame:
    """Activities with both keys: is the pair on the bridge, do the accounts agree?"""
    both = condense(t["crm_activities"].where("contact_id is not null and opportunity_id is not null"),
                    ["opportunity_id", "contact_id"])
    known = t["crm_opportunity_contacts"].select("opportunity_id", "contact_id").distinct()
    on_bridge = both.join(known, ["opportunity_id", "contact_id"], "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)))
    same = _pairs_with_accounts(both, t).agg(weighted_if(F.col("deal_account") == F.col("person_account")))
    return both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("both_total")).select(
        "*", F.lit(on_bridge.scalar()).alias("pair_on_bridge"), F.lit(same.scalar()).alias("same_account"))


def activity_chronology(t: Tables, as_of: str) -> DataFrame:
    a = t["crm_activities"]
    people = condense(a.where("contact_id is not null"), ["contact_id", "occurred_at"]).join(
        t["crm_contacts"].select("contact_id", "created_at"), "contact_id")
    deals = condense(a.where("opportunity_id is not null"), ["opportunity_id", "occurred_at"]).join(
        t["crm_opportunities"].select("opportunity_id", "created_at", "close_date"), "opportunity_id")
    at = F.col("occurred_at")
    first = people.agg(weighted_if(at < F.col("created_at")).alias("before_contact_created"))
    return _with_scalars(first, deals.agg(
        weighted_if(at < F.col("created_at")).alias("before_opportunity_created"),
        weighted_if(at > midnight(F.col("close_date"))).alias("after_opportunity_close")))


def type_scope_association(t: Tables, as_of: str) -> DataFrame:
    return cramers_v(_scoped(t), "type", "scope")


def lonely(t: Tables, as_of: str) -> DataFrame:
    deals = missing_children(t["crm_opportunities"].select("opportunity_id"), "opportunity_id",
                             t["crm_opportunity_contacts"], "opportunity_id")
    accounts = missing_children(t["crm_accounts"].select("account_id"), "account_id", t["crm_contacts"], "account_id")
    return _with_scalars(deals.agg(_n().alias("opportunities_without_contacts")),
                         accounts.agg(_n().alias("accounts_without_contacts")))


AUDITS: dict[str, Callable[[Tables, str], DataFrame]] = {
    "crm_account_names": account_names,
    "crm_top_account_names": top_account_names,
    "crm_account_size": account_size,
    "crm_contact_rules": contact_rules,
    "crm_lead_scores_by_status": lead_scores_by_status,
    "crm_lead_score_association": lead_score_association,
    "crm_lead_conversion": lead_conversion,
    "crm_deal_chronology": deal_chronology,
    "crm_close_before_created_by_stage": close_before_created_by_stage,
    "crm_deal_amount_against_revenue": deal_amount_against_revenue,
    "crm_stage_summary": stage_summary,
    "crm_stage_amount_association": stage_amount_association,
    "crm_bridge": bridge,
    "crm_activity_scope": activity_scope,
    "crm_activity_pairs": activity_pairs,
    "crm_activity_chronology": activity_chronology,
    "crm_type_scope_association": type_scope_association,
    "crm_lonely": lonely,
}
