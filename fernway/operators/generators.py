"""Repeatable made-up visits and practices, any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The value sets of the generated columns.
INSURERS = ["BlueCross", "Aetna", "UnitedHealth"]
PLANS = ["HMO", "PPO", "EPO"]
REASONS = [
    "Routine Checkup",
    "Flu Symptoms",
    "Injury",
    "Chronic Condition",
    "Follow-up",
    "Prescription Refill",
    "Surgery",
    "Physical Therapy",
]
CITIES = ["LA", "Chicago", "NY"]
NETWORK = ["In Network", "Out of Network"]


def draw(what: str, key: Column, seed: int, n: int) -> Column:
    """A number below ``n`` fixed by name, key and seed; equal on every run and engine."""
    digest = F.md5(F.concat_ws("|", F.lit(what), key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def pick(what: str, key: Column, seed: int, values: list[str]) -> Column:
    listed = F.array(*map(F.lit, values))
    return F.get(listed, draw(what, key, seed, len(values)).cast("int"))


def gen_visits(ids: DataFrame, key: str, seed: int = 1, patients: int = 15) -> DataFrame:
    """One visit per id (``spark.range(n)`` or a key column); insurer and plan are fixed per
    patient, one visit in five has no policy number. Every column depends on the id alone,
    so generation is a projection and any part can be made again."""
    visit = F.col(key)
    who = draw("patient", visit, seed, patients)
    rows = ids.select(visit.alias("visit_id"), who.alias("_who"))
    visit, who = F.col("visit_id"), F.col("_who")
    has_policy = draw("has_policy", visit, seed, 5) > 0
    return rows.select(
        "visit_id",
        F.concat(F.lit("First"), who.cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), who.cast("string")).alias("last_name"),
        pick("insurer", who, seed, INSURERS).alias("insurance_provider_name"),
        pick("plan", who, seed, PLANS).alias("insurance_type"),
        F.when(
            has_policy, F.md5(F.concat_ws("|", F.lit("policy"), visit.cast("string")))
        ).alias("insurance_policy_number"),
        F.concat(F.lit("user"), visit.cast("string"), F.lit("@example.com")).alias("email"),
        pick("city", visit, seed, CITIES).alias("city"),
        (draw("practice", visit, seed, 9000) + 1000).alias("practice_visited_practice_id"),
        F.concat(F.lit("Note "), draw("note", visit, seed, 1_000_000).cast("string")).alias(
            "doctor_notes"
        ),
        pick("reason", visit, seed, REASONS).alias("reason_for_visit"),
    )


def gen_practices(ids: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """One practice per id, ids from 0; names count from 1, phone numbers from 0."""
    i = F.col(key)
    return ids.select(
        F.concat(F.lit("Medical Center "), (i + 1).cast("string")).alias("practice_name"),
        pick("city", i, seed, CITIES).alias("city"),
        F.concat(F.lit("(555) 555-12"), F.format_string("%02d", i)).alias("contact"),
        F.concat(
            F.lit("INS-"), (draw("insurance", i, seed, 9000) + 1000).cast("string")
        ).alias("insurance_id"),
        pick("insurer", i, seed, INSURERS).alias("insurance_company"),
        pick("plan", i, seed, PLANS).alias("insurance_plan_type"),
        pick("network", i, seed, NETWORK).alias("network_status"),
    )
