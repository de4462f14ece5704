"""Declared schemas of the streams and external tables."""

from pyspark.sql import types as T


def _struct(**fields: str | T.DataType) -> T.StructType:
    """A schema from names and types; needs no running session."""
    schema = T.StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


def _texts(names: str) -> dict[str, str]:
    return {name: "string" for name in names.split()}


EVENT_SCHEMA = _struct(**_texts("user_id event_type timestamp session_id page"))

CLAIM_SCHEMA = _struct(
    **_texts("claim_id patient_id hospital_id treatment_code diagnosis_code"),
    claim_amount="double",
    approved_amount="double",
    **_texts("insurance_status claim_date"),
    is_fraud="boolean",
    fraud_score="double",
    **_texts("status patient_state insurance_type hospital_state hospital_type"),
)

ARTICLE_SCHEMA = _struct(
    **_texts(
        "id title description content url author source_name published_at collected_at source category"
    ),
    score="integer",
    comments="integer",
)

ORDERS_SCHEMA = _struct(
    **_texts(
        "order_id customer_id order_status order_purchase_timestamp order_approved_at "
        "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
    )
)

ITEMS_SCHEMA = _struct(
    order_id="string",
    order_item_id="integer",
    **_texts("product_id seller_id shipping_limit_date"),
    price="double",
    freight_value="double",
)

RECIPE_SCHEMA = _struct(
    id="integer",
    name="string",
    description="string",
    ingredients=T.ArrayType(T.StringType()),
    cuisine="string",
    difficulty="string",
    prep_time="integer",
    cook_time="integer",
    rating="float",
)

READINGS_SCHEMA = _struct(
    user_id="long",
    record="long",
    hourly=_struct(time=T.ArrayType(T.TimestampType()), value=T.ArrayType(T.DoubleType())),
)
