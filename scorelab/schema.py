"""Column contracts of the account table and the token layout (fixed values)."""

from __future__ import annotations

# Feature groups and their order (order is part of the contract).
DEMOGRAPHIC = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"]
PAY_STATUS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILL_AMT = ["BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6"]
PAY_AMT = ["PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6"]
TARGET = "DEFAULT"
FEATURES = DEMOGRAPHIC + PAY_STATUS + BILL_AMT + PAY_AMT
ALL_COLUMNS = FEATURES + [TARGET]

# Valid code domains.
VALID_SEX = [1, 2]
VALID_EDUCATION = [1, 2, 3, 4]
VALID_MARRIAGE = [1, 2, 3]
VALID_PAY = list(range(-2, 9))

# The tokeniser's field families.
CATEGORICAL = ["SEX", "EDUCATION", "MARRIAGE"]
NUMERICAL = ["LIMIT_BAL", "AGE"] + BILL_AMT + PAY_AMT

# Token layout. Position 0 = CLS; then 3 categorical,
# 6 PAY status, 14 numeric. group ids: 0 cls, 1 demographic, 2 pay status,
# 3 bill amounts, 4 payment amounts.
GROUP_NAMES = {0: "cls", 1: "demographic", 2: "pay_status", 3: "bill_amt", 4: "pay_amt"}


def token_layout() -> list[tuple[int, str, int, str, int | None]]:
    """(pos, feature, group_id, group_name, month) for the 24 token positions."""
    rows: list[tuple[int, str, int, str, int | None]] = [(0, "CLS", 0, "cls", None)]
    seq = CATEGORICAL + PAY_STATUS + NUMERICAL
    for pos, feat in enumerate(seq, start=1):
        if feat in PAY_STATUS:
            gid, month = 2, PAY_STATUS.index(feat) + 1
        elif feat.startswith("BILL_AMT"):
            gid, month = 3, int(feat[-1])
        elif feat.startswith("PAY_AMT"):
            gid, month = 4, int(feat[-1])
        else:
            gid, month = 1, None
        rows.append((pos, feat, gid, GROUP_NAMES[gid], month))
    return rows
