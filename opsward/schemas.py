"""Schemas, domains and limits of the six tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType

TABLES = ("facilities", "departments", "patients", "referrals", "appointments", "ed_visits")

RAW_COLUMNS = {
    "facilities": ["facility_id", "facility_name", "hospital_region", "city", "facility_type", "bed_capacity"],
    "departments": [
        "department_id", "facility_id", "department_name", "specialty_group",
        "routine_target_days", "urgent_target_days", "appointment_wait_target_mins",
    ],
    "patients": [
        "patient_id", "date_of_birth", "gender", "ethnicity", "city", "deprivation_quintile", "enrolment_date",
    ],
    "referrals": [
        "referral_id", "patient_id", "department_id", "referral_date", "urgency", "referral_status",
        "first_appointment_date", "closed_date", "referral_source", "priority_score",
    ],
    "appointments": [
        "appointment_id", "patient_id", "department_id", "referral_id", "scheduled_datetime",
        "check_in_time", "seen_time", "appointment_status", "appointment_type", "booking_channel",
    ],
    "ed_visits": [
        "visit_id", "patient_id", "facility_id", "arrival_time", "triage_category", "discharge_time",
        "disposition", "admitted_flag", "presenting_group",
    ],
}

CLEAN_DDL = {
    "facilities": (
        "facility_id string, facility_name string, hospital_region string, city string, "
        "facility_type string, bed_capacity int"
    ),
    "departments": (
        "department_id string, facility_id string, department_name string, specialty_group string, "
        "routine_target_days int, urgent_target_days int, appointment_wait_target_mins int"
    ),
    "patients": (
        "patient_id string, date_of_birth date, gender string, ethnicity string, city string, "
        "deprivation_quintile smallint, enrolment_date date, ethnicity_missing_flag boolean, "
        "date_of_birth_issue_flag boolean, deprivation_quintile_issue_flag boolean"
    ),
    "referrals": (
        "referral_id string, patient_id string, department_id string, referral_date date, urgency string, "
        "referral_status string, first_appointment_date date, closed_date date, referral_source string, "
        "priority_score smallint, patient_id_issue_flag boolean, department_id_issue_flag boolean, "
        "urgency_issue_flag boolean, priority_score_issue_flag boolean, timeline_issue_flag boolean"
    ),
    "appointments": (
        "appointment_id string, patient_id string, department_id string, referral_id string, "
        "scheduled_datetime timestamp_ntz, check_in_time timestamp_ntz, seen_time timestamp_ntz, "
        "appointment_status string, appointment_type string, booking_channel string, "
        "patient_id_issue_flag boolean, department_id_issue_flag boolean, referral_id_issue_flag boolean, "
        "status_timestamp_issue_flag boolean, timeline_issue_flag boolean"
    ),
    "ed_visits": (
        "visit_id string, patient_id string, facility_id string, arrival_time timestamp_ntz, "
        "triage_category smallint, discharge_time timestamp_ntz, disposition string, admitted_flag boolean, "
        "presenting_group string, patient_id_issue_flag boolean, facility_id_issue_flag boolean, "
        "triage_category_issue_flag boolean, missing_discharge_time_flag boolean, "
        "timeline_issue_flag boolean, admission_consistency_issue_flag boolean"
    ),
    "reference_mappings": "mapping_group string, raw_value_normalised string, standard_value string",
}

PRIMARY_KEYS = {
    "facilities": ["facility_id"],
    "departments": ["department_id"],
    "patients": ["patient_id"],
    "referrals": ["referral_id"],
    "appointments": ["appointment_id"],
    "ed_visits": ["visit_id"],
    "reference_mappings": ["mapping_group", "raw_value_normalised"],
}

# (child table, child column, parent table); the parent column has the same name.
RELATIONSHIPS = [
    ("departments", "facility_id", "facilities"),
    ("referrals", "patient_id", "patients"),
    ("referrals", "department_id", "departments"),
    ("appointments", "patient_id", "patients"),
    ("appointments", "department_id", "departments"),
    ("appointments", "referral_id", "referrals"),
    ("ed_visits", "patient_id", "patients"),
    ("ed_visits", "facility_id", "facilities"),
]
OPTIONAL_RELATIONSHIPS = {("appointments", "referral_id")}

QUALITY_FLAGS = {
    "patients": ["ethnicity_missing_flag", "date_of_birth_issue_flag", "deprivation_quintile_issue_flag"],
    "referrals": [
        "patient_id_issue_flag", "department_id_issue_flag", "urgency_issue_flag",
        "priority_score_issue_flag", "timeline_issue_flag",
    ],
    "appointments": [
        "patient_id_issue_flag", "department_id_issue_flag", "referral_id_issue_flag",
        "status_timestamp_issue_flag", "timeline_issue_flag",
    ],
    "ed_visits": [
        "patient_id_issue_flag", "facility_id_issue_flag", "triage_category_issue_flag",
        "missing_discharge_time_flag", "timeline_issue_flag", "admission_consistency_issue_flag",
    ],
}

# Sentinel sets differ between checks; fixed values.
ID_SENTINELS = frozenset({"", "n/a", "unknown", "null"})
SCORE_SENTINELS = frozenset({"", "n/a", "na", "unknown", "null"})
VALUE_SENTINELS = frozenset({"", "n/a", "na", "unknown", "null"})
CATEGORY_SENTINELS = frozenset({"n/a", "na"})

# Columns that may hold NULL in the clean layer; every other clean column is required.
NULLABLE = {
    "facilities": {"bed_capacity"},
    "departments": set(),
    "patients": {"date_of_birth", "ethnicity", "deprivation_quintile"},
    "referrals": {
        "patient_id", "department_id", "urgency", "first_appointment_date", "closed_date", "priority_score",
    },
    "appointments": {"patient_id", "department_id", "referral_id", "check_in_time", "seen_time"},
    "ed_visits": {"patient_id", "facility_id", "triage_category", "discharge_time"},
}

# Dates and times that are read from text; a value that no form reads breaks a rule. Births have a flag of their own.
READ_AS_DATE = {"patients": ("enrolment_date",), "referrals": ("referral_date", "first_appointment_date", "closed_date")}
READ_AS_TIME = {
    "appointments": ("scheduled_datetime", "check_in_time", "seen_time"), "ed_visits": ("arrival_time", "discharge_time"),
}
READ_FROM_TEXT = READ_AS_DATE | READ_AS_TIME

# Text widths of the clean layer; fixed values.
MAX_LENGTHS = {
    "facilities": {
        "facility_id": 10, "facility_name": 100, "hospital_region": 20, "city": 60, "facility_type": 50,
    },
    "departments": {"department_id": 10, "facility_id": 10, "department_name": 80, "specialty_group": 30},
    "patients": {"patient_id": 12, "gender": 30, "ethnicity": 30, "city": 60},
    "referrals": {
        "referral_id": 12, "patient_id": 12, "department_id": 10, "urgency": 20, "referral_status": 20,
        "referral_source": 40,
    },
    "appointments": {
        "appointment_id": 12, "patient_id": 12, "department_id": 10, "referral_id": 12,
        "appointment_status": 25, "appointment_type": 50, "booking_channel": 30,
    },
    "ed_visits": {
        "visit_id": 12, "patient_id": 12, "facility_id": 10, "disposition": 30, "presenting_group": 30,
    },
}

# Statuses, bands and value lists of the domain.
BACKLOG_STATUSES = ("Open", "Waiting")
WAIT_BANDS = (("0-14 days", 0, 14), ("15-30 days", 15, 30), ("31-60 days", 31, 60))
LAST_WAIT_BAND = "Over 60 days"
URGENCIES = ("Routine", "Semi-Urgent", "Urgent")
APPOINTMENT_TYPES = ("First Specialist Assessment", "Follow-up", "Procedure", "Telehealth")
BOOKING_CHANNELS = ("Referral Team", "Phone", "Patient Portal", "Clinic")
DISPOSITIONS = ("Discharged", "Admitted", "Transferred", "Left Before Treatment")
PRESENTING_GROUPS = ("Injury", "Respiratory", "Cardiac", "Abdominal", "Neurological", "Infection", "Other")
YES_NO = {"yes": True, "no": False}
FIRST_VALID_BIRTH_DATE = dt.date(1900, 1, 1)


@dataclass(frozen=True)
class Domain:
    """Everything that differs between two installations of the same six tables."""

    snapshot: dt.date = dt.date(2026, 8, 1)
    regions: tuple[str, ...] = ("Northern", "Midland", "Central", "Southern")
    return_window_hours: int = 7 * 24
    #: Forms of dates and times beside ISO text, tried in this order; a time may also be a date alone.
    date_formats: tuple[str, ...] = ("yyyyMMdd", "yyyy/M/d", "d MMM yyyy", "MMM d, yyyy")
    time_formats: tuple[str, ...] = ("yyyyMMdd HH:mm:ss", "yyyy/M/d HH:mm:ss", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm")
    id_patterns: dict[str, str] = field(default_factory=lambda: {
        "facilities": "F[0-9]{3}", "departments": "D[0-9]{3}", "patients": "P[0-9]{6}",
        "referrals": "R[0-9]{7}", "appointments": "A[0-9]{7}", "ed_visits": "V[0-9]{7}",
    })


def value_lists(domain: Domain) -> dict[str, dict[str, tuple[str, ...]]]:
    """Allowed values per table and column."""
    return {
        "facilities": {
            "hospital_region": domain.regions,
            "facility_type": ("Tertiary Hospital", "Regional Hospital", "Community Hospital"),
        },
        "departments": {"specialty_group": ("Medical", "Surgical")},
        "patients": {
            "gender": ("Female", "Male", "Gender Diverse", "Unknown"),
            "ethnicity": ("European", "Maori", "Pacific", "Asian", "Other"),
        },
        "referrals": {
            "urgency": URGENCIES,
            "referral_status": ("Open", "Waiting", "Booked", "Completed", "Cancelled", "Declined"),
        },
        "appointments": {
            "appointment_status": ("Completed", "No Show", "Cancelled", "Rescheduled", "Scheduled"),
            "appointment_type": APPOINTMENT_TYPES,
            "booking_channel": BOOKING_CHANNELS,
        },
        "ed_visits": {"disposition": DISPOSITIONS, "presenting_group": PRESENTING_GROUPS},
    }


def clean_columns(table: str) -> list[str]:
    return [part.split()[0] for part in CLEAN_DDL[table].split(",")]


def raw_schema(table: str) -> StructType:
    """All-text schema of a raw table; types are never inferred."""
    return StructType([StructField(name, StringType(), True) for name in RAW_COLUMNS[table]])
