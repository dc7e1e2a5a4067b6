"""Output column contracts of the named queries; order-insensitive."""

import pytest

from mercato.registry import QUERIES
from tests.conftest import SF001

CONTRACTS = {
    "order_metrics": "order_id total_order_value total_freight item_count",
    "fact_orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at "
                   "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date "
                   "total_order_value total_freight item_count",
    "fact_orders_inner": "order_id customer_id order_status order_purchase_timestamp total_order_value "
                         "total_freight item_count",
    "fact_order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value "
                        "item_revenue",
    "fact_payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "fact_reviews": "review_id order_id review_score review_comment_title review_comment_message "
                    "review_creation_date review_answer_timestamp",
    "dim_customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
    "dim_products": "product_category_name product_id product_category_name_english",
    "dim_sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "sales_by_product": "product_id units_sold product_revenue average_price total_freight",
    "sales_by_seller": "seller_id items_sold orders_handled seller_revenue seller_freight distinct_orders",
    "sales_by_category": "product_category_name product_category_name_english units_sold category_revenue "
                         "average_price",
    "executive_kpis": "revenue orders customers item_records distinct_item_seq average_order_value",
    "item_order_consistency": "item_count order_count items_below_orders",
    "monthly_revenue": "month revenue",
    "order_status_mix": "order_status count",
    "top_revenue_label": "product_label units_sold revenue",
    "top_customer_city": "customer_city customers",
    "business_insights": "insight",
    "product_sales_fallback": "product_id units_sold product_revenue",
    "top_products_by_units": "product_label units_sold",
    "top_products_by_revenue": "product_label product_revenue",
    "category_performance": "category units_sold revenue",
    "customer_kpis": "active_customers customer_revenue avg_customer_value",
    "revenue_by_state": "customer_state revenue",
    "customers_by_city": "customer_city customers",
    "seller_sales_fallback": "seller_id items_sold seller_revenue",
    "top_sellers_by_revenue": "seller_label seller_revenue",
    "top_sellers_by_items": "seller_label items_sold",
    "seller_performance": "seller_label seller_revenue items_sold",
    "payment_kpis": "payment_value payment_records avg_installments",
    "payment_value_by_type": "payment_type payment_value",
    "payment_usage_by_type": "payment_type count",
    "review_kpis": "average_rating review_records valid_ratings",
    "rating_distribution": "rating reviews",
    "low_rating_reviews": "order_id review_score review_comment_message",
    "freight_kpis": "total_freight avg_freight freight_to_revenue_pct",
    "freight_vs_value": "total_order_value total_freight",
    "table_counts": "table_name row_count",
    "null_profile": "column_name null_count row_count",
    "orders_per_customer": "orders_placed customers",
    "low_sales_products": "product_id units_sold",
    "payment_behaviour": "payment_type payment_installments payments avg_payment_value share",
    "review_trend": "month reviews average_rating",
    "poor_review_categories": "category reviews average_rating low_share",
    "category_order_volume": "category orders average_price",
    "seller_order_volume": "seller_id orders",
    "customer_value_by_location": "customer_state customers revenue avg_customer_value",
    "delivery_by_location": "customer_state delivered_orders late_orders avg_delivery_days",
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_output_columns(spark, name):
    assert sorted(QUERIES[name](spark, SF001).columns) == sorted(CONTRACTS[name].split())


def test_delivery_performance_extends_the_contract(spark):
    cols = QUERIES["delivery_performance"](spark, SF001).columns
    assert cols[:4] == ["delivered_orders", "late_orders", "late_rate", "avg_delivery_days"]
