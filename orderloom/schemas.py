"""The order contract's fixed values and the column layouts of every table."""

from __future__ import annotations

CONTRACT_VERSION = "order-contract-v2"

# Fixed values of the order contract.
STATUSES = (
    "DRAFT",
    "UNCONFIRMED",
    "UNFULFILLED",
    "PARTIALLY_FULFILLED",
    "FULFILLED",
    "PARTIALLY_RETURNED",
    "RETURNED",
    "CANCELED",
    "EXPIRED",
)
CURRENCIES = ("USD", "EUR", "PLN")
UNCOUNTED_STATUSES = ("CANCELED", "DRAFT")
CONFLICT_ERROR = "Conflicting payload for the same order and source version"
DEFAULT_REJECT_RATE_LIMIT = 0.05
MINIMUM_TESTS = 7
MAX_AGE_HOURS = 24.0
OVERLAP_SECONDS = 300
SETTLE_SECONDS = 5

MONEY = "decimal(18,2)"
SUM_MONEY = "decimal(38,2)"

LINE = (
    "struct<line_id string, product_name string, sku string, quantity int, "
    f"unit_amount {MONEY}, line_amount {MONEY}>"
)

EXTRACTION = (
    "struct<mode string, source string, upper string, lower string, "
    "base_watermark string, range_semantics string, watermark_advance boolean>"
)

LANDING = "record bigint, raw string"
RAW = "source_file string, line_number bigint, line_key bigint, raw string"
ACCEPTED = (
    "line_key bigint, order_id string, order_number string, created_at timestamp_ntz, "
    f"updated_at timestamp_ntz, status string, channel string, currency string, "
    f"total_amount {MONEY}, lines array<{LINE}>, payload_json string, payload_hash string"
)
MANIFEST = (
    "snapshot_id string, extracted_at string, raw_fingerprint string, "
    "outcomes_fingerprint string, input_count bigint, accepted_count bigint, "
    "rejected_count bigint, duplicate_count bigint, conflict_count bigint, "
    f"reject_rate double, quality_gate string, extraction {EXTRACTION}, "
    "duration_seconds double, contract_version string"
)
EXCLUSION = (
    "snapshot_id string, reason string, excluded_at string, manifest_fingerprint string"
)
RELEASE_INPUT = (
    "snapshot_id string, extracted_at string, accepted_count bigint, rejected_count bigint, "
    f"duplicate_count bigint, extraction {EXTRACTION}, manifest_fingerprint string"
)
RELEASE = (
    "release_id string, created_at string, base_release string, input_signature string, "
    "contract_version string"
)
RELEASE_STATE = (
    "release_id string, step int, status string, at string, content_fingerprint string, "
    "results_fingerprint string, data_tests_passed int, duration_seconds double, "
    "model_version string"
)
TEST_RESULT = "test_name string, failures bigint, passed boolean"
PUBLICATION = (
    "seq bigint, release_id string, content_fingerprint string, published_at string, "
    "watermarks map<string,string>, data_tests_passed int, snapshots bigint, "
    "accepted_count bigint, rejected_count bigint, duplicate_count bigint"
)
