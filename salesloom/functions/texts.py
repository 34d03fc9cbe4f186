"""Texts shown with problems and root causes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Printf-style texts of the problem and root-cause reports.
LOW_REVENUE = "Revenue is %.1f%% below market average ($%s vs $%s)"
LOW_REVENUE_ADVICE = ("Investigate pricing strategy, product mix, and marketing campaigns. "
                      "Compare with top-performing companies in your sector.")
LOW_REVENUE_PRODUCTS = ("Focus on promoting top products: %s. Consider increasing inventory for these "
                        "high-performing items and running targeted promotions.")
LOW_REVENUE_BRANDS = ("Focus on top brands: %s. Increase marketing for these brands and ensure adequate stock "
                      "levels.")
LOW_AVG_SALE = "Average sale amount is %.1f%% lower than market ($%.2f vs $%.2f)"
LOW_AVG_SALE_ADVICE = ("Your average sale is $%.2f compared to market average of $%.2f. Consider upselling "
                       "strategies, product bundling, and training staff on value-added selling.")
LOW_AVG_SALE_PRODUCTS = ("Your average sale is $%.2f compared to market average of $%.2f. Focus on upselling top "
                         "products: %s. Create product bundles and train staff on cross-selling techniques.")
LOW_COUNT = "Sales count is %.1f%% below market average (%d vs %d)"
LOW_COUNT_ADVICE = "You have %d sales vs market average of %d. "
LOW_COUNT_STAFF = ("Your employees average %.1f sales each. Consider employee training, performance "
                   "incentives, or increasing staff during peak hours.")
LOW_COUNT_NO_STAFF = ("Investigate customer acquisition strategies, improve store visibility, review "
                      "opening hours, and analyze foot traffic patterns.")
LOW_REGION = "Region revenue is %.1f%% below market average"
LOW_REGION_ADVICE = "Investigate regional market conditions, competition, or economic factors"
FACTOR_AVG_SALE = "low average sale amount (%.1f%% below market)"
FACTOR_COUNT = "low sales count (%.1f%% below market)"
FACTOR_REVENUE = "significant revenue gap"
REVENUE_CAUSE_ADVICE = "Your revenue is %.1f%% below market average. "
REVENUE_CAUSE_FACTORS = "Contributing factors: %s. "
REVENUE_CAUSE_ACTIONS = (
    "Immediate actions: 1) Analyze top-performing products and increase inventory, 2) Review pricing strategy, "
    "3) Improve employee sales performance, 4) Enhance marketing and customer acquisition, "
    "5) Compare with market leaders to identify gaps.")
BRAND_DIFFERS = "Your top brand \"%s\" (%.1f%%) differs from market leader \"%s\" (%.1f%%), with a %.1f%% gap."
BRAND_DIFFERS_ADVICE = "Consider adding market-leading brand \"%s\" to your portfolio. "
BRAND_ALSO = "Also consider: %s. "
BRAND_SHARE = "These brands represent %.1f%% of market revenue and could help capture more market share."
BRAND_WEAK = "Your top brand \"%s\" represents %.1f%% of revenue vs %.1f%% in market (%.1f%% gap)."
BRAND_WEAK_ADVICE = (
    "Increase focus on \"%s\": enhance marketing, improve product placement, and run targeted promotions. "
    "Also consider diversifying your brand portfolio to reduce dependency on a single brand.")
BRAND_COVERAGE = ("Your top 3 brands cover %.1f%% of revenue vs %.1f%% in market. "
                  "Only %d of your top 3 brands match market leaders.")
BRAND_COVERAGE_ADVICE = "Align your brand portfolio with market trends. "
BRAND_ADDING = "Consider adding: %s. "
BRAND_COVERAGE_END = "These brands could help improve your market coverage."
PRICE_HIGH = "Average product price is %.1f%% higher than market average ($%.2f vs $%.2f)"
PRICE_HIGH_ADVICE = (
    "Your average price is $%.2f (%.1f%% above market average of $%.2f). Review pricing strategy: consider "
    "competitive pricing for top-selling products. Analyze which products customers are price-sensitive about "
    "and adjust accordingly. Consider promotional pricing or bundle deals to maintain margins while attracting "
    "price-conscious customers.")
PRICE_LOW = "Average product price is %.1f%% below market average ($%.2f vs $%.2f)"
PRICE_LOW_ADVICE = (
    "Your average price is $%.2f (%.1f%% below market average of $%.2f). While lower prices can attract "
    "customers, this may indicate undervaluing products or missing upselling opportunities. Consider: 1) Review "
    "product mix - add premium products, 2) Train staff on upselling, 3) Create product bundles, 4) Improve "
    "product presentation to justify higher prices.")
EMPLOYEE_WEAK = "Only %.1f%% of employees (%d/%d) have average revenue above market average"
EMPLOYEE_WEAK_ADVICE = (
    "Only %d out of %d employees (%.1f%%) have average revenue above market average ($%.2f). Company average "
    "revenue per employee is $%.2f vs market average of $%.2f. ")
EMPLOYEE_LEADERS = (
    "Top performers: %s. Analyze their techniques and share best practices with underperforming staff. "
    "Consider: 1) Training programs on sales techniques, 2) Performance-based incentives, 3) Regular coaching "
    "sessions, 4) Clear sales targets and KPIs, 5) Pair low performers with top performers for mentorship.")
EMPLOYEE_NO_LEADERS = (
    "Consider: 1) Comprehensive sales training, 2) Performance incentives and bonuses, 3) Regular performance "
    "reviews, 4) Mentorship programs, 5) Clear sales targets and daily/weekly goals, 6) Identify and address "
    "barriers to performance.")
CATEGORY_DIFFERS = (
    "Your top category \"%s\" is different from market leader \"%s\". Market leader \"%s\" represents %.1f%% of "
    "market revenue, while your top category \"%s\" represents %.1f%% of your revenue.")
CATEGORY_DIFFERS_ADVICE = (
    "Your top category \"%s\" is different from market leader \"%s\". Consider expanding into popular market "
    "categories: %s. These categories represent %.1f%% of market revenue and show strong market demand.")
CATEGORY_ALIGNED = ("Your category mix is aligned with market trends. Continue monitoring category performance "
                    "and adjust strategy as needed.")
CATEGORY_WEAK = (
    "Your top category \"%s\" represents %.1f%% of your revenue vs %.1f%% in market (%.1f%% difference). This "
    "suggests the category is less important to your business than to the market.")
CATEGORY_WEAK_ADVICE = (
    "Your top category \"%s\" represents %.1f%% of your revenue vs %.1f%% in market. Review your \"%s\" category "
    "strategy: 1) Analyze which products in this category are underperforming, 2) Compare your product mix with "
    "market leaders, 3) Improve product placement and visibility, 4) Consider promotional campaigns focused on "
    "this category to increase its contribution.")
LOCALE_NUMBER = "#,##0.###"


def say(text: str, *values: Column) -> Column:
    return F.format_string(text, *values)


def locale_number(c: Column) -> Column:
    """Thousands separators and at most three decimals."""
    return F.call_function("format_number", c, F.lit(LOCALE_NUMBER))


def listed(array: Column, n: int = 2) -> Column:
    """First n entries, comma separated."""
    return F.concat_ws(", ", F.slice(array, 1, n))
