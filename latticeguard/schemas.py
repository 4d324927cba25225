"""Feature schema: one constant drives the StructType, encoders and assembler."""
from __future__ import annotations

SCHEMA_VERSION = "1.0.0"

# Feature order is the model's column order; never reorder.
# (name, kind, categories or None)
FEATURES: tuple[tuple[str, str, dict[str, float] | None], ...] = (
    ("algorithm_RSA", "numeric", None),
    ("algorithm_ECC", "numeric", None),
    ("key_size", "numeric", None),
    ("quantum_vulnerable", "numeric", None),
    ("internet_accessible", "numeric", None),
    ("has_public_cert", "numeric", None),
    ("network_zone", "categorical", {"public": 0.0, "dmz": 1.0, "internal": 2.0, "isolated": 3.0}),
    ("financial_data", "numeric", None),
    ("customer_data", "numeric", None),
    ("regulated_system", "numeric", None),
    ("criticality", "categorical", {"LOW": 0.0, "MEDIUM": 1.0, "HIGH": 2.0, "CRITICAL": 3.0}),
    ("dependency_count", "numeric", None),
    ("loc_estimate", "numeric", None),
    ("migration_complexity", "categorical", {"LOW": 0.0, "MEDIUM": 1.0, "HIGH": 2.0}),
    ("asset_age_days", "numeric", None),
    ("previous_incident_flag", "numeric", None),
)
LABEL = "risk_score"
FEATURE_NAMES: list[str] = [f[0] for f in FEATURES]
ECC_FAMILY = ("ECDSA", "EdDSA", "ECDH")


def required_columns(columns: list[str], required: list[str], where: str = "input") -> None:
    """Fail naming every missing column (metadata only, no Spark job)."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"{where} is missing expected column(s): {missing}")
