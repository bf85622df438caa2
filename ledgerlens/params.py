"""Parameters: the reference's constants and the values used on the test
tables (orders there run 1995-01-01 .. 2001-08-01 and the money scale
differs, so several reference constants would give empty or one-sided
results).  Every operator takes these as arguments."""

TEST = dict(
    spine_start="1995-01-01", spine_end="2001-08-01",
    years=(1995, 1996, 1997, 1998, 1999, 2000, 2001),
    base_year=1995, snapshot="2001-08-02",
    nba_tiers=(750_000, 1_500_000, 2_250_000), clv_tiers=(150_000, 300_000, 450_000),
    affinity_min=1400, basket_support=0.005, lift_cuts=(0.99, 0.98),
    band_edges=(-0.01, 0.001, 0.02, 0.05, 0.08, 0.10),
    band_labels=("0%", "1-2%", "3-5%", "6-8%", "9-10%"),
    base_band="0%", target_band="9-10%", price_change=-0.095,
    outlier_k=1.5, anomaly_k=2.0, max_order_total=400_000, max_discount=0.05,
    min_margin=0.30, min_customers=1000, min_orders=5000,
    churn_model=(-0.5, (2.0, -0.6, 0.3, 0.1)),  # a given model, to check the scoring by SQL
    filter_years=(1996, 1997), filter_countries=("ASIA", "EUROPE"),
    filter_channels=("BUILDING", "MACHINERY"),
)
