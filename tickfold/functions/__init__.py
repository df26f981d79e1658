from tickfold.functions.scalars import (
    decode_utf8,
    format_date,
    hwm_key,
    int_div,
    key_millis,
    millis_of,
    parse_int,
    sensor_id_of,
    strict_int,
    timestamp_of,
)

__all__ = [
    "decode_utf8",
    "format_date",
    "hwm_key",
    "int_div",
    "key_millis",
    "millis_of",
    "parse_int",
    "sensor_id_of",
    "strict_int",
    "timestamp_of",
]
