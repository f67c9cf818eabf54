"""Record schemas and the fixed values the business rules are written in."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, order and types of a transaction's fields.
TX_SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)
TX_COLUMNS = TX_SCHEMA.names

# A detected transaction as the stream stores it.
DETECTED_SCHEMA = T.StructType(
    [
        *TX_SCHEMA.fields,
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("balance_diff_orig", T.DoubleType()),
        T.StructField("balance_diff_dest", T.DoubleType()),
        T.StructField("is_transfer_or_cashout", T.IntegerType()),
        T.StructField("amount_to_balance_ratio", T.DoubleType()),
        T.StructField("blacklist_flag", T.IntegerType()),
        T.StructField("rule_fraud_flag", T.IntegerType()),
        T.StructField("is_fraud_detected", T.IntegerType()),
    ]
)

SCORED_SCHEMA = T.StructType(
    [
        *DETECTED_SCHEMA.fields,
        T.StructField("ml_fraud_flag", T.IntegerType()),
        T.StructField("ml_probability", T.DoubleType()),
        T.StructField("reason", T.StringType()),
    ]
)

# What detection adds, in that order.
DETECTION_COLUMNS = [n for n in DETECTED_SCHEMA.names if n not in (*TX_COLUMNS, "ingested_at")]

# The fields of an alert message.
ALERT_COLUMNS = [
    "nameOrig",
    "nameDest",
    "amount",
    "type",
    "is_fraud_detected",
    "blacklist_flag",
    "rule_fraud_flag",
    "ingested_at",
]

# Rule thresholds, type names and ranges of the record contract.
RISKY_TYPES = ["TRANSFER", "CASH_OUT"]
ALL_TYPES = ["TRANSFER", "CASH_OUT", "PAYMENT", "CASH_IN", "DEBIT"]
DRAIN_LOW, DRAIN_HIGH = 0.95, 1.05
LARGE_AMOUNT = 200_000
DEST_TOLERANCE = 1.0
AMOUNT_LIMIT = 100_000_000
STEP_MIN, STEP_MAX = 1, 744
NAME_MIN, NAME_MAX = 2, 50
BOX_PLOT_LIMIT = 2_000_000
RATE_BANDS = [1.0, 2.5]

# Defaults of a submitted record.
RECORD_DEFAULTS = {
    "step": 1,
    "type": "TRANSFER",
    "nameOrig": "C1234567890",
    "oldbalanceOrg": 0.0,
    "newbalanceOrig": 0.0,
    "nameDest": "C9876543210",
    "oldbalanceDest": 0.0,
    "newbalanceDest": 0.0,
    "isFraud": 0,
    "isFlaggedFraud": 0,
}

# Model inputs, in vector order.
FEATURE_COLUMNS = [
    "amount",
    "type_idx",
    "oldbalanceOrg",
    "newbalanceOrig",
    "oldbalanceDest",
    "newbalanceDest",
    "balance_diff_orig",
    "balance_diff_dest",
    "amount_ratio_orig",
    "zero_balance_after",
    "drain_ratio",
    "dest_balance_anomaly",
    "dest_is_merchant",
    "is_large_transaction",
]
RESIDUAL_FEATURES = [
    "step",
    "amount",
    "oldbalanceOrg",
    "newbalanceOrig",
    "oldbalanceDest",
    "newbalanceDest",
]

# Display names of the search table and of the type filter.
DISPLAY_NAMES = {
    "step": "Khung (Step)",
    "type": "Loại",
    "amount": "Số Tiền",
    "nameOrig": "Tài Khoản Gửi",
    "oldbalanceOrg": "Số Dư Gốc (Gửi)",
    "newbalanceOrig": "Số Dư Mới (Gửi)",
    "nameDest": "Tài Khoản Nhận",
    "oldbalanceDest": "Số Dư Gốc (Nhận)",
    "newbalanceDest": "Số Dư Mới (Nhận)",
    "isFraud": "Gian Lận Thực Sư",
    "isFlaggedFraud": "Đánh Dấu Lừa Đảo",
    "balance_diff_orig": "Chênh Lệch Dư (Gửi)",
    "balance_diff_dest": "Chênh Lệch Dư (Nhận)",
    "is_transfer_or_cashout": "Loại Chuyển/Rút",
    "amount_to_balance_ratio": "Tỷ Lệ Tiền/Dư",
    "blacklist_flag": "Là Sổ Đen",
    "rule_fraud_flag": "Vi Phạm Rule Kích Cỡ",
    "is_fraud_detected": "Bắt Bởi Model",
    "ingested_at": "Thời Gian Xử Lý",
}
DISPLAY_TYPES = {
    "Chuyển Khoản": "TRANSFER",
    "Rút Tiền Khách": "CASH_OUT",
    "Nạp Tiền": "CASH_IN",
    "Thanh Toán": "PAYMENT",
    "Ghi Nợ": "DEBIT",
}
