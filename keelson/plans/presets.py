"""Table specs of the four captured source tables (bookings, flights,
aircraft, loyalty transactions): row images, keys, and business rules with
their quarantine reasons.  Use them with ``plans.jobs``."""

from __future__ import annotations

from keelson.operators import quality as Q
from keelson.spec import TableSpec

# Accepted statuses / types and quarantine reasons of the source systems.
BOOKING_STATUSES = ["PENDING", "CONFIRMED", "CANCELLED", "REFUNDED"]
FLIGHT_STATUSES = ["SCHEDULED", "BOARDING", "DEPARTED", "ARRIVED", "DELAYED", "CANCELLED", "DIVERTED"]
TRANSACTION_TYPES = ["EARN", "REDEEM", "EXPIRE", "ADJUSTMENT"]
REASON_BOOKING_STATUS = "invalid booking_status value"
REASON_BOOKING_REFERENCE = "missing booking_reference"
REASON_FLIGHT_STATUS = "invalid flight_status value"
REASON_AIRPORTS = "missing or identical origin/destination airport"
REASON_HOURS = "negative total_flight_hours"
REASON_GROUNDING = "grounded aircraft missing grounded_reason"
REASON_TRANSACTION_TYPE = "invalid transaction_type value"
REASON_MILES = "non-positive miles_amount"

BOOKINGS = TableSpec(
    name="bookings", key=("booking_id",), source_system="reservations",
    after_ddl="booking_id int, customer_id int, booking_reference string, booking_status string, "
              "booking_channel string, currency string",
    rules=(Q.accepted_values("has_valid_status", "booking_status", BOOKING_STATUSES, REASON_BOOKING_STATUS),
           Q.required("has_valid_reference", "booking_reference", REASON_BOOKING_REFERENCE)))

FLIGHTS = TableSpec(
    name="flights", key=("flight_id",), source_system="flightops", keep_before=True,
    after_ddl="flight_id string, schedule_id int, origin_airport string, destination_airport string, "
              "flight_status string, aircraft_registration string",
    rules=(Q.accepted_values("has_valid_status", "flight_status", FLIGHT_STATUSES, REASON_FLIGHT_STATUS),
           Q.distinct_pair("has_valid_airports", "origin_airport", "destination_airport", REASON_AIRPORTS)))

AIRCRAFT = TableSpec(
    name="aircraft", key=("aircraft_registration",), source_system="maintenance", keep_before=True,
    after_ddl="aircraft_registration string, model_id int, total_flight_hours decimal(10,2), "
              "total_flight_cycles int, is_grounded boolean, grounded_reason string",
    decimals={"total_flight_hours": (10, 2)},
    rules=(Q.null_or_nonneg("has_valid_hours", "total_flight_hours", REASON_HOURS),
           Q.implication("has_valid_grounding", "is_grounded", "grounded_reason", REASON_GROUNDING)))

LOYALTY_TRANSACTIONS = TableSpec(
    name="loyalty_transactions", key=("transaction_id",), source_system="loyalty", keep_before=True,
    after_ddl="transaction_id int, loyalty_account_id int, transaction_type string, miles_amount int, "
              "reference_type string",
    rules=(Q.accepted_values("has_valid_type", "transaction_type", TRANSACTION_TYPES, REASON_TRANSACTION_TYPE),
           Q.positive("has_valid_amount", "miles_amount", REASON_MILES)))

# Constraints of the captured tables in their source DDL
# (primary / unique keys, required columns, accepted values, references to
# reference tables), checked as data-quality tests.
DQ_TESTS = {
    "bookings": {"unique": ["booking_id", "booking_reference"],
                 "not_null": ["booking_reference", "booking_status"],
                 "accepted": {"booking_status": BOOKING_STATUSES},
                 "relationships": {"customer_id": ("customers", "customer_id")}},
    "flights": {"unique": ["flight_id"], "not_null": ["flight_status"],
                "accepted": {"flight_status": FLIGHT_STATUSES},
                "relationships": {"origin_airport": ("airports", "airport_code"),
                                  "destination_airport": ("airports", "airport_code")}},
    "aircraft": {"unique": ["aircraft_registration"],
                 "relationships": {"model_id": ("aircraft_models", "model_id")}},
    "loyalty_transactions": {"unique": ["transaction_id"], "not_null": ["transaction_type", "miles_amount"],
                             "accepted": {"transaction_type": TRANSACTION_TYPES},
                             "relationships": {"loyalty_account_id": ("loyalty_accounts", "loyalty_account_id")}},
    "flight_events": {"unique": ["event_id"], "not_null": ["event_type", "event_timestamp"],
                      "relationships": {"flight_id": ("flights", "flight_id")}},
    "delays": {"unique": ["delay_id"], "not_null": ["delay_minutes"], "relationships": {"flight_id": ("flights", "flight_id")}},
    "diversions": {"unique": ["diversion_id"],
                   "relationships": {"flight_id": ("flights", "flight_id"), "original_destination": ("airports", "airport_code"),
                                     "diverted_to": ("airports", "airport_code")}},
    "flight_cancellations": {"unique": ["cancellation_id"], "relationships": {"flight_id": ("flights", "flight_id")}},
    "gates": {"unique": ["gate_id"], "not_null": ["gate_number"], "relationships": {"airport_code": ("airports", "airport_code")}},
    "loyalty_accounts": {"unique": ["loyalty_account_id", "member_number"],
                         "not_null": ["customer_id", "member_number", "enrollment_date"],
                         "relationships": {"current_tier_id": ("loyalty_tiers", "tier_id")}},
    "maintenance_events": {"unique": ["maintenance_event_id"], "not_null": ["maintenance_type", "event_status"],
                           "accepted": {"event_status": ["DUE", "SCHEDULED", "IN_PROGRESS", "COMPLETED"]},
                           "relationships": {"aircraft_registration": ("aircraft", "aircraft_registration"),
                                             "schedule_id": ("maintenance_schedules", "schedule_id")}},
    "defects": {"unique": ["defect_id"], "not_null": ["defect_description", "defect_status"],
                "accepted": {"severity": ["MINOR", "MAJOR", "CRITICAL"], "defect_status": ["OPEN", "IN_REPAIR", "RESOLVED"]},
                "relationships": {"aircraft_registration": ("aircraft", "aircraft_registration"),
                                  "maintenance_event_id": ("maintenance_events", "maintenance_event_id")}},
    "maintenance_costs": {"unique": ["cost_id"],
                          "relationships": {"maintenance_event_id": ("maintenance_events", "maintenance_event_id"),
                                            "part_id": ("parts", "part_id")}},
    "booking_items": {"unique": ["booking_item_id"], "not_null": ["flight_id", "fare_amount"],
                      "relationships": {"booking_id": ("bookings", "booking_id"), "passenger_id": ("passengers", "passenger_id"),
                                        "fare_class_id": ("fare_classes", "fare_class_id")}},
    "payments": {"unique": ["payment_id"], "not_null": ["amount", "payment_status"],
                 "accepted": {"payment_status": ["PENDING", "COMPLETED", "FAILED"]},
                 "relationships": {"booking_id": ("bookings", "booking_id")}},
    "tickets": {"unique": ["ticket_id", "ticket_number"], "not_null": ["ticket_number", "ticket_status"],
                "accepted": {"ticket_status": ["ISSUED", "USED", "CANCELLED", "REFUNDED"]},
                "relationships": {"booking_item_id": ("booking_items", "booking_item_id")}},
    "booking_cancellations": {"unique": ["cancellation_id"], "relationships": {"booking_id": ("bookings", "booking_id")}},
    "refunds": {"unique": ["refund_id"], "not_null": ["refund_amount", "refund_status"],
                "accepted": {"refund_status": ["REQUESTED", "APPROVED", "PROCESSED", "REJECTED"]},
                "relationships": {"payment_id": ("payments", "payment_id")}},
}


def references() -> list[tuple[str, str, str]]:
    """The declared references as (child, column, parent): what
    ``rollups.cascade`` walks."""
    return [(child, column, parent) for child, tests in DQ_TESTS.items()
            for column, (parent, _) in tests.get("relationships", {}).items()]


# Append-only ledgers skip the current-state step.
LEDGERS = {LOYALTY_TRANSACTIONS.name}

SPECS = {s.name: s for s in (BOOKINGS, FLIGHTS, AIRCRAFT, LOYALTY_TRANSACTIONS)}


def _captured(name, key, ddl, system, decimals=None, temporal=None):
    return TableSpec(name=name, key=(key,), after_ddl=ddl, source_system=system,
                     decimals=decimals or {}, temporal=temporal or {})


# The other captured tables: a spec each, no rules (they have no Silver job
# in the source project).  Row images follow the source DDL; TIMESTAMP
# columns arrive as epoch microseconds and DATE columns as epoch days.
OTHER_CAPTURED = {s.name: s for s in (
    _captured("flight_events", "event_id",
              "event_id int, flight_id string, event_type string, event_details string, event_timestamp timestamp_ntz",
              "flightops", temporal={"event_timestamp": "micros"}),
    _captured("delays", "delay_id",
              "delay_id int, flight_id string, delay_minutes int, delay_reason string, recorded_at timestamp_ntz",
              "flightops", temporal={"recorded_at": "micros"}),
    _captured("diversions", "diversion_id",
              "diversion_id int, flight_id string, original_destination string, diverted_to string, "
              "diversion_reason string, diverted_at timestamp_ntz", "flightops", temporal={"diverted_at": "micros"}),
    _captured("flight_cancellations", "cancellation_id",
              "cancellation_id int, flight_id string, cancellation_reason string, cancelled_at timestamp_ntz",
              "flightops", temporal={"cancelled_at": "micros"}),
    _captured("gates", "gate_id", "gate_id int, airport_code string, gate_number string, terminal string", "flightops"),
    _captured("loyalty_accounts", "loyalty_account_id",
              "loyalty_account_id int, customer_id string, member_number string, current_tier_id int, "
              "total_miles_earned int, total_miles_redeemed int, miles_balance int, enrollment_date date",
              "loyalty", temporal={"enrollment_date": "days"}),
    _captured("maintenance_events", "maintenance_event_id",
              "maintenance_event_id int, aircraft_registration string, schedule_id int, maintenance_type string, "
              "event_status string, due_date date, started_at timestamp_ntz, completed_at timestamp_ntz, "
              "is_unscheduled boolean", "maintenance",
              temporal={"due_date": "days", "started_at": "micros", "completed_at": "micros"}),
    _captured("defects", "defect_id",
              "defect_id int, aircraft_registration string, maintenance_event_id int, defect_description string, "
              "severity string, defect_status string, reported_at timestamp_ntz, resolved_at timestamp_ntz",
              "maintenance", temporal={"reported_at": "micros", "resolved_at": "micros"}),
    _captured("maintenance_costs", "cost_id",
              "cost_id int, maintenance_event_id int, part_id int, labor_cost decimal(12,2), "
              "parts_cost decimal(12,2), currency string", "maintenance",
              decimals={"labor_cost": (12, 2), "parts_cost": (12, 2)}),
    _captured("booking_items", "booking_item_id",
              "booking_item_id int, booking_id int, passenger_id int, flight_id string, fare_class_id int, "
              "seat_number string, fare_amount decimal(10,2)", "reservations", decimals={"fare_amount": (10, 2)}),
    _captured("payments", "payment_id",
              "payment_id int, booking_id int, payment_method string, amount decimal(12,2), currency string, "
              "payment_status string, paid_at timestamp_ntz", "reservations",
              decimals={"amount": (12, 2)}, temporal={"paid_at": "micros"}),
    _captured("tickets", "ticket_id",
              "ticket_id int, booking_item_id int, ticket_number string, ticket_status string, issued_at timestamp_ntz",
              "reservations", temporal={"issued_at": "micros"}),
    _captured("booking_cancellations", "cancellation_id",
              "cancellation_id int, booking_id int, cancelled_by string, cancellation_reason string, "
              "cancelled_at timestamp_ntz", "reservations", temporal={"cancelled_at": "micros"}),
    _captured("refunds", "refund_id",
              "refund_id int, payment_id int, refund_amount decimal(12,2), refund_reason string, refund_status string, "
              "requested_at timestamp_ntz, processed_at timestamp_ntz", "reservations",
              decimals={"refund_amount": (12, 2)}, temporal={"requested_at": "micros", "processed_at": "micros"}),
)}

ALL_CAPTURED = {**SPECS, **OTHER_CAPTURED}
