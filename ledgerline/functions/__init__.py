from ledgerline.functions.parse import (
    batch_date_of,
    batch_date_to_date,
    matches,
    md5_uuid,
    parse_amount,
    parse_ts,
)

__all__ = [
    "batch_date_of",
    "batch_date_to_date",
    "matches",
    "md5_uuid",
    "parse_amount",
    "parse_ts",
]
