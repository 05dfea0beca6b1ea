"""Values that must stay exactly as they are, or results change meaning.

FIXED VALUES: names, word lists, constants, patterns and formats of the payment
feeds. They are data, not logic; everything else in the package refers to them.
"""

# Topics and the channel each one carries.
TOPICS = {
    "bank": "bank_transactions",
    "gateway": "gateway_transactions",
    "processor": "processor_transactions",
}
ALERT_TOPIC = "fraud_alerts"
RESULT_TOPIC = "reconciliation_results"

# Source names by channel; every other source name belongs to the processor channel.
BANK_SOURCES = ("bank",)
GATEWAY_SOURCES = ("Stripe", "PayPal", "Adyen", "Braintree", "Square")

# Status words.
STATUSES = {
    "bank": ("completed", "pending", "failed", "declined"),
    "gateway": ("completed", "pending", "failed", "error"),
    "processor": ("completed", "pending", "rejected", "timeout"),
}
FAILED_STATUSES = ("failed", "declined", "rejected", "error", "timeout")
SUSPICIOUS_STATUSES = ("failed", "declined")
STATUS_WHEN_ABSENT = "unknown"

# Reconciliation.
AMOUNT_TOLERANCE = 0.01
PRESENT, MISSING = "present", "missing"
MATCH, MISMATCH = "match", "mismatch"
VERDICTS = ("incomplete", "amount_mismatch", "status_mismatch", "reconciled")

# Risk score weights and limit.
RISK_WEIGHTS = (
    ("max_txn_count_hourly", 0.5),
    ("location_count", 0.1),
    ("device_count", 0.1),
    ("ip_count", 0.1),
    ("failed_txn_ratio", 5.0),
)
HIGH_RISK_ABOVE = 5.0

# Fraud rules.
LARGE_AMOUNT = 200.0
REPEAT_COUNT = 2
REPEAT_TOTAL = 300.0
BURST_COUNT = 5
BURST_SECONDS = 30

# Plain-text message format and the texts of the verdict lines.
TEXT_MESSAGE = r"^Transaction: (\w+), amount=(\d+\.\d+)"
REASON_JOINER = " & "
REASON_LARGE = "Large transaction of %s exceeds threshold of %s"
REASON_REPEAT = "Multiple transactions totaling %.2f from user %s"
REASON_STATUS = "Transaction has suspicious status: %s"
LINE_ALERT = "FRAUD ALERT: %s - %.2f - %s"
LINE_NORMAL = "NORMAL: %s - %.2f"
LINE_INVALID = "Invalid transaction format: %s"
LINE_MISSING = "Missing required fields in transaction: %s"
LINE_ERROR = "Error processing: %s"

# Look-back windows of the two batch jobs, and the trigger of streams.
RECONCILE_HOURS = 6
FEATURE_DAYS = 7
STREAM_TRIGGER = "5 seconds"
