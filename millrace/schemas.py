"""Record schemas of the text inputs, and of the test tables' derived forms."""

# The field order of each headerless CSV file.
WATER_SENSOR = "id string, ts bigint, vc int"
USER_BEHAVIOR = (
    "user_id bigint, item_id bigint, category_id int, behavior string, ts bigint"
)
MARKETING_BEHAVIOR = "user_id bigint, behavior string, channel string, ts bigint"
ADS_CLICK = "user_id bigint, ad_id bigint, province string, city string, ts bigint"
ORDER_EVENT = "order_id bigint, event_type string, tx_id string, event_time bigint"
TX_EVENT = "tx_id string, pay_channel string, event_time bigint"
LOGIN_EVENT = "user_id bigint, ip string, event_type string, event_time bigint"

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
