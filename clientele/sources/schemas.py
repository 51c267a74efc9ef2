"""Column layout of every export, as text where the export is text."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {"long": LongType(), "int": IntegerType(), "str": StringType(), "date": DateType()}


def layout(*fields: str) -> StructType:
    """``name`` or ``name:type`` items to a schema; text is the default type."""
    split = (f.partition(":") for f in fields)
    return StructType([StructField(name, _TYPES[kind or "str"]) for name, _, kind in split])


CONTACTS = layout(
    "id:long", "first_name", "last_name", "birthday", "phone_1", "phone_2", "phone_3",
    "bill_city", "bill_state", "bill_country", "ship_city", "ship_state", "ship_country",
    "email", "opt_country", "owner_id:long", "ip_country", "ip_city", "ip_state",
    "year_birth", "date_created", "lead_source", "dob",
)
INVOICES = layout(
    "order_id:long", "contact_id:long", "description", "first_name", "last_name",
    "product_ids", "inv_total", "balance", "date", "lead_source",
)
ITEM_PRICES = layout("product_id:long", "product_price")
PRODUCTS = layout("id:long", "product_name", "price", "category")
MAIL_ACTIVITY = layout(
    "contact_id:long", "first_name", "last_name", "email", "batch_id:long", "sent", "opened",
    "clicked", "link",
)
MAIL_BATCHES = layout("batch_id:long", "template")
OPPORTUNITIES = layout(
    "contact_id:long", "opp_id:long", "opp", "contact_name", "phone_number", "first_name",
    "last_name", "street", "city", "state", "post_code", "owner", "stage", "percent",
    "next_action_date", "next_action", "note", "num_campaigns:int", "status_id", "objection",
    "opp_leads", "move_date", "date_create", "last_update", "est_closed_date",
    "order_revenue", "closed_date", "loss_reason",
)
WEEKLY_PURCHASES = layout(
    "contact_id:long", "name", "phone", "email", "country", "product", "invoice"
)
TIME_ZONES = layout("city", "cc", "time_zone")
NO_CALL = layout("id:long", "reason")
DO_NOT_SEND = layout("date", "name", "email", "phone_number")
OPT_OUTS = layout("contact_id:long", "type")
BROADCASTS = layout("mail_id:long", "date", "template", "total_sent:int", "dev_num:int")
MAIL_OPENS = layout("contact_id:long", "mail_id:long", "sent", "opened")
ATTRIBUTED_INVOICES = layout(
    "inv_id:long", "contact_id:long", "product_id:long", "product", "inv_total", "date"
)
RECENT_ACTIVITY = layout(
    "contact_id:long", "first_name", "last_name", "email", "type", "description", "date"
)
CONSULT_BOOKINGS = layout("date", "provider", "name", "email", "phone_number", "contact_id:long")
CONSULT_SIGNUPS = layout("date", "provider", "record_date")
SALES = layout(
    "name", "date", "inv_id:long", "product_id", "product_name", "contact_id:long",
    "inv_total", "total_paid", "referral_id:long", "sources",
)
SELLER_SCHEDULE = layout("week_number", "name", "days:int", "target_sale:int")
CALL_ATTEMPTS = layout(
    "opty_id", "date_1", "caller_1", "date_2", "caller_2", "date_3", "caller_3"
)
CALL_FOLLOW_UP = layout("name", "date_1", "caller_1", "date_2", "caller_2", "out_come")
DIAL_RESULTS = layout(
    "first_name", "phone", "duration", "result", "note", "id:long", "link", "what_to_sell",
    "time_zone", "caller",
)
DISPOSITIONS = layout("disposition", "next_round", "action")
CALL_LOG = layout(
    "id:long", "date", "time", "length", "from_who", "cid", "cid_num", "port_1", "to_whom",
    "cid_name", "cid_number", "port_2", "pin", "digits", "tc:int",
)
CALL_TARGETS = layout("caller", "target_seconds:int")
AUTO_LIST = layout("name", "duration", "result", "note", "id:long", "caller")
GEO_CELLS = layout("id:long", "geocell", "ct:int")
EVENT_LIST = layout(
    "wsid:long", "full_wk", "ws_date:date", "instructors", "city", "title", "n_clients:int",
    "total_amount", "description", "designation",
)
MEMBERS = layout("email", "member_id:long")

LAYOUTS = {name.lower(): value for name, value in list(globals().items()) if isinstance(value, StructType)}

# Names that versions of the exports use for the layouts' columns.
ALIASES = {
    "contacts": {"data_created": "date_created", "date_of_birth": "dob", "contact_id": "id"},
    "invoices": {"inv_id": "order_id", "product_id": "product_ids"},
    "products": {"product_id": "id"},
    "mail_activity": {"id": "contact_id", "link_clicked": "link"},
    "opportunities": {"perecent": "percent", "colsed_date": "closed_date", "loss_reson": "loss_reason"},
    "weekly_purchases": {"id": "contact_id"},
    "opt_outs": {"id": "contact_id"},
    "recent_activity": {"id": "contact_id"},
    "consult_bookings": {"id": "contact_id"},
    "sales": {"source": "sources"},
    "call_log": {"legnth": "length"},
    "members": {"sky": "member_id"},
}


def aliases_of(schema: StructType) -> dict[str, str]:
    """The other names of a layout's columns."""
    return next((ALIASES.get(name, {}) for name, value in LAYOUTS.items() if value is schema), {})
