"""Declared schemas of the raw tables; nothing is inferred at ingest."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
}


def _table(key: str, **columns: str) -> T.StructType:
    """``key`` is a required int; the other columns are nullable."""
    fields = [T.StructField(key, T.IntegerType(), False)]
    return T.StructType(fields + [T.StructField(n, _KINDS[k], True) for n, k in columns.items()])


# Names, order and types of the raw columns.
SCHEMAS = {
    "citizen_info": _table(
        "citizen_id",
        full_name="string",
        national_id="string",
        phone_number="string",
        email="string",
        birth_date="date",
        address="string",
        occupation="string",
    ),
    "hr_employee": _table(
        "employee_id",
        department="string",
        job_title="string",
        c01="string",
        c02="double",
        c03="string",
        c04="string",
        c05="string",
        remarks="string",
    ),
    "administrative_record": _table(
        "record_id",
        service_type="string",
        applicant_name="string",
        cccd_number="string",
        submission_date="date",
        status="string",
        clerk_notes="string",
    ),
    "transaction_log": _table(
        "tx_id",
        tx_timestamp="timestamp",
        tx_type="string",
        amount="double",
        source_account="string",
        target_account="string",
        tax_id="string",
        customer_name="string",
        tx_message="string",
        fraud_notes="string",
    ),
}
