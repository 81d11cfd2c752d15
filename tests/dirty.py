"""Dirty landing rows: a valid view with one change each, and both verdicts."""

HEADER = (
    "event_id,user_id,session_id,event_type,product_id,product_name,"
    "category,price,quantity,total_amount,timestamp"
)
VALID = {
    "event_id": "d01",
    "user_id": "1",
    "session_id": "s1",
    "event_type": "view",
    "product_id": "1",
    "product_name": "thing",
    "category": "stuff",
    "price": "9.99",
    "quantity": "1",
    "total_amount": "9.99",
    "timestamp": "2024-01-01 00:00:00",
}

# (event id, change, kept by the filters, reasons of the contract)
CASES = [
    ("d01", {}, True, []),
    ("", {}, False, ["event_id_null"]),
    ("d03", {"user_id": ""}, False, ["user_id_null"]),
    ("d04", {"event_type": ""}, False, ["event_type_null"]),
    ("d05", {"product_id": ""}, False, ["product_id_null"]),
    ("d06", {"event_type": "click"}, False, ["event_type_unknown"]),
    ("d07", {"event_type": "VIEW"}, False, ["event_type_unknown"]),
    ("d08", {"event_type": " view"}, False, ["event_type_unknown"]),
    ("d09", {"price": "0"}, False, ["price_not_positive"]),
    ("d10", {"price": "-1"}, False, ["price_not_positive"]),
    ("d11", {"price": ""}, False, ["price_not_positive"]),
    ("d12", {"total_amount": "0"}, False, ["total_amount_not_positive"]),
    ("d13", {"price": "0.004"}, True, []),
    ("d14", {"price": "1.005"}, True, []),
    ("d15", {"price": "NaN"}, True, ["price_not_finite"]),
    ("d16", {"price": "Inf"}, True, ["price_not_finite"]),
    ("d17", {"user_id": "abc"}, False, ["user_id_null"]),
    ("d18", {"quantity": "x"}, True, ["quantity_null"]),
    ("d19", {"session_id": ""}, True, ["session_id_null"]),
    ("d20", {"category": ""}, True, ["category_null"]),
    ("d21", {"timestamp": "not-a-ts"}, True, ["event_timestamp_null"]),
    ("d22", {"timestamp": "2024-01-01T00:00:00"}, True, ["event_timestamp_null"]),
    ("d23", {"total_amount": "123456789"}, True, ["total_amount_too_large"]),
    ("x" * 37, {}, True, ["event_id_too_long"]),
    ("d25", {"category": "c" * 51}, True, ["category_too_long"]),
    ("d26", {"quantity": "-1"}, True, []),
    ("d01", {}, True, []),
    ("d30", {"price": "-Inf"}, False, ["price_not_positive", "price_not_finite"]),
    ("d31", {"total_amount": "99999999.994"}, True, []),
    ("d32", {"total_amount": "99999999.995"}, True, ["total_amount_too_large"]),
    ("d33", {"event_type": "purchase", "quantity": "3"}, True, []),
    ("d34", {"user_id": "99999999999"}, False, ["user_id_null"]),
    ("d35", {"product_name": "p" * 101}, True, ["product_name_too_long"]),
]
SHORT = ("d28", "d28,1,s1,view,1,thing,stuff,9.99,1,9.99")  # no timestamp
EXTRA = ("d29", ",".join({**VALID, "event_id": "d29"}.values()) + ",surplus")


def line(event_id, change):
    return ",".join({**VALID, "event_id": event_id, **change}.values())


def dirty_lines():
    return [line(i, change) for i, change, *_ in CASES] + [SHORT[1], EXTRA[1]]


def write_csv(path, lines, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    staged = path.parent / f"_{path.name}"  # hidden until complete
    staged.write_text("\n".join([header, *lines]) + "\n")
    staged.rename(path)
    return str(path.parent)


def valid_lines(ids, **change):
    return [line(i, change) for i in ids]
