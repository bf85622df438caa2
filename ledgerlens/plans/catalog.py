"""Registered queries: operator + test parameters, keyed by function name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators import dashboard as K
from ledgerlens.operators import predictive as M
from ledgerlens.operators import reports as R
from ledgerlens.operators import quality as D
from ledgerlens.operators import sql_patterns as Q
from ledgerlens.params import TEST as P
from ledgerlens.sources.adapter import Tables, load_tables

_CACHE: dict[str, Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Logical tables over ``sf_dir`` (lazy frames), rebuilt when the session
    changes."""
    cached = _CACHE.get(sf_dir)
    if cached is None or cached.spark is not spark:
        cached = _CACHE[sf_dir] = load_tables(spark, sf_dir)
    return cached


def _bind(fn: Callable[..., DataFrame], **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    s, g, p = P["nba_tiers"]
    return {
        "date_spine_daily": _bind(Q.date_spine_daily, start=P["spine_start"], end=P["spine_end"]),
        "monthly_pivot": _bind(Q.monthly_pivot, years=P["years"]),
        "rolling_revenue": _bind(Q.rolling_revenue, n=3),
        "customer_deciles": _bind(Q.customer_deciles, n=10),
        "customer_journey": _bind(Q.customer_journey),
        "category_affinity": _bind(Q.category_affinity, min_count=P["affinity_min"]),
        "abc_classification": _bind(Q.abc_classification, a=0.80, b=0.95),
        "cohort_retention": _bind(Q.cohort_retention, max_offset=12),
        "weekly_anomaly": _bind(Q.weekly_anomaly, k=P["anomaly_k"]),
        "next_best_action": _bind(Q.next_best_action, snapshot=P["snapshot"], silver=s, gold=g,
                                  platinum=p, limit=50),
        "row_counts": _bind(D.row_counts),
        "null_checks": _bind(D.null_checks),
        "uniqueness_checks": _bind(D.uniqueness_checks),
        "referential_checks": _bind(D.referential_checks),
        "range_checks": _bind(D.range_checks, max_order_total=P["max_order_total"],
                              max_discount=P["max_discount"]),
        "business_rule_checks": _bind(D.business_rule_checks),
        "order_value_outliers": _bind(D.order_value_outliers, k=P["outlier_k"]),
        "completeness_summary": _bind(D.completeness_summary),
        "duplicate_line_items": _bind(D.duplicate_line_items, limit=20),
        "quality_score": _bind(D.quality_score),
        "quality_gate": _bind(D.quality_gate, max_discount=P["max_discount"],
                              min_customers=P["min_customers"], min_orders=P["min_orders"]),
        **predictive_queries(),
        **dashboard_queries(),
    }


def predictive_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    bands = dict(edges=P["band_edges"], labels=P["band_labels"])
    churn = dict(snapshot=P["snapshot"], threshold=180)
    strong, moderate = P["lift_cuts"]
    return {
        "revenue_forecast": _bind(M.revenue_forecast, months=6, base_year=P["base_year"]),
        "forecast_fit": _bind(M.forecast_fit, base_year=P["base_year"]),
        "churn_features": _bind(M.churn_features, **churn),
        "churn_predictions": _bind(M.churn_scores, **churn),
        "churn_metrics": _bind(M.churn_metrics_flat, **churn),
        "churn_risk_summary": _bind(M.churn_risk_summary, **churn),
        "churn_risk_distribution": _bind(M.churn_risk_distribution, **churn),
        "confusion_matrix": _bind(M.confusion_matrix, **churn),
        "churn_scored": _bind(M.churn_scores, **churn, model=P["churn_model"]),
        "churn_scored_metrics": _bind(M.churn_metrics_flat, **churn, model=P["churn_model"]),
        "churn_scored_risk_summary": _bind(M.churn_risk_summary, **churn, model=P["churn_model"]),
        "churn_scored_risk_distribution": _bind(M.churn_risk_distribution, **churn, model=P["churn_model"]),
        "churn_scored_confusion": _bind(M.confusion_matrix, **churn, model=P["churn_model"]),
        "price_elasticity": _bind(M.price_elasticity_bands, **bands),
        "elasticity_summary": _bind(M.elasticity_summary, **bands, base=P["base_band"],
                                    target=P["target_band"], price_change=P["price_change"]),
        "market_basket": _bind(M.market_basket, min_support=P["basket_support"], strong=strong,
                               moderate=moderate),
        "clv_prediction": _bind(M.clv_prediction, snapshot=P["snapshot"], tiers=P["clv_tiers"]),
        "clv_tier_summary": _bind(M.clv_tier_summary, snapshot=P["snapshot"], tiers=P["clv_tiers"]),
        "discount_effect": _bind(M.discount_effect, **bands),
        "discount_recommendation": _bind(M.discount_recommendation, **bands,
                                         min_margin=P["min_margin"]),
        "discount_band_impact": _bind(M.discount_band_impact, **bands),
    }


def _forecast_view(t: Tables, months: int, base_year: int) -> DataFrame:
    """K17 over the M1 output."""
    return K.forecast_view(M.revenue_forecast(t, months, base_year))


def dashboard_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    s, g, p = P["nba_tiers"]
    filters = dict(years=P["filter_years"], countries=P["filter_countries"],
                   channels=P["filter_channels"])
    return {
        "executive_kpis": _bind(K.executive_kpis),
        "executive_kpis_filtered": _bind(K.executive_kpis, years=P["filter_years"],
                                         countries=P["filter_countries"],
                                         channels=P["filter_channels"]),
        "monthly_revenue": _bind(K.monthly_revenue),
        "monthly_revenue_filtered": _bind(K.monthly_revenue, **filters),
        "mom_growth": _bind(K.mom_growth),
        "mom_growth_filtered": _bind(K.mom_growth, **filters),
        "revenue_by_channel_filtered": _bind(K.revenue_by, dim="channel", **filters),
        "revenue_by_channel": _bind(K.revenue_by, dim="channel"),
        "revenue_by_country_top8": _bind(K.revenue_by, dim="country", top=8),
        "revenue_by_payment": _bind(K.revenue_by, dim="payment_method"),
        "revenue_by_country_filtered": _bind(K.revenue_by, dim="country", **filters),
        "status_distribution_filtered": _bind(K.status_distribution, **filters),
        "payment_mix": _bind(K.payment_mix),
        "status_distribution": _bind(K.status_distribution),
        "return_reasons": _bind(K.return_reasons),
        "return_status_counts": _bind(K.return_status_counts),
        "returns_kpis": _bind(K.returns_kpis),
        "returns_over_time": _bind(K.returns_over_time),
        "inventory_health": _bind(K.inventory_health),
        "top_products": _bind(K.top_products, n=10),
        "best_sellers": _bind(K.top_products, n=20),
        "filter_domains": _bind(K.filter_domains),
        "chart_channel_revenue": _bind(K.chart_channel_revenue),
        "chart_top_products": _bind(K.chart_top_products, n=5, name_chars=30),
        "forecast_view": _bind(_forecast_view, months=6, base_year=P["base_year"]),
        "category_performance": _bind(R.category_performance),
        "monthly_summary": _bind(R.monthly_summary),
        "channel_performance": _bind(R.channel_performance),
        "payment_method_mix": _bind(R.payment_method_mix),
        "customer_ltv_segments": _bind(R.customer_ltv_segments, silver=s, gold=g, platinum=p),
        "rfm_scores": _bind(R.rfm_scores, snapshot=P["snapshot"]),
        "rfm_segments": _bind(R.rfm_segments, snapshot=P["snapshot"]),
        "new_vs_returning": _bind(R.new_vs_returning),
        "cohort_matrix": _bind(R.cohort_matrix, max_offset=12),
        "revenue_by_country": _bind(R.revenue_by_country),
        "top_cities": _bind(R.top_cities, n=20),
        "revenue_by_age_gender": _bind(R.revenue_by_age_gender),
        "status_share": _bind(R.status_share),
        "delivery_time_by_country": _bind(R.delivery_time_by_country),
        "return_rate_by_category": _bind(R.return_rate_by_category),
        "return_reason_breakdown": _bind(R.return_reason_breakdown),
        "low_stock_alerts": _bind(R.low_stock_alerts),
        "ytd_and_mom": _bind(R.ytd_and_mom),
        "category_rank_monthly": _bind(R.category_rank_monthly),
        "purchase_gap": _bind(R.purchase_gap),
        "time_intelligence": _bind(R.time_intelligence),
        "date_dimension": _bind(R.date_dimension),
        "return_rate_trend": _bind(R.return_rate_trend),
        "rating_vs_sales": _bind(R.rating_vs_sales),
    }
