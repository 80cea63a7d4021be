"""The sample observation of the input format, as producers send it."""

from __future__ import annotations

import json

# One record of the declared 28 columns.
SAMPLE = {
    "timestamp": 1609459200,
    "pid": "product-7",
    "merchant_id": "m1",
    "merchant_name": "merchant one",
    "shop_name": "Shop & Söhne",
    "review_number": 310,
    "review_score": 3.75,
    "shop_review_number": 4821,
    "title": "Enamel mug, blue",
    "is_pb": 0,
    "is_hwc": 0,
    "is_verified": 1,
    "total_bought": 17,
    "total_wishlist": 640,
    "tags": ["kitchen", "mug"],
    "category_ids": ["t1", "t2"],
    "category_paths": ["Home:Kitchen"],
    "category_l1_ids": ["t1"],
    "category_l2_ids": ["t2"],
    "category_l3_ids": [],
    "leaf_category_ids": ["t2"],
    "price": 4.0,
    "shipping_price": 1.25,
    "sold": 0.5,
    "update_time": "2021-01-05 08:10:00",
    "shop_open_time": "2019-03-01 09:00:00",
    "gen_time": "2021-01-05 08:11:30",
    "data_update_time": "2021-01-05 08:12:45",
}

# Expected metrics when the sample is the only record of its product.
SAMPLE_METRICS = {
    "new_review_number_last_30": 0,
    "sold_last_1": 0.5,
    "sold_last_3": 1.5,
    "sold_last_7": 3.5,
    "sold_last_30": 15.0,
    "sold_last_1_pop": 0.0,
    "sold_2_to_last": 0.5,
    "sold_3_to_last": 0.5,
    "sold_4_to_last": 0.5,
    "sold_5_to_last": 0.5,
    "sold_6_to_last": 0.5,
    "sold_7_to_last": 0.5,
    "gmv_last_1": 2.0,
    "gmv_last_3": 6.0,
    "gmv_last_7": 14.0,
    "gmv_last_30": 60.0,
}

# Flags are booleans in results.
SAMPLE_RECORD = SAMPLE | {"is_pb": False, "is_hwc": False, "is_verified": True}
SAMPLE_DOCUMENT = SAMPLE_METRICS | SAMPLE_RECORD


def message(arrival: int, **changes) -> str:
    """The sample with changes, as one JSON line with its arrival columns."""
    record = SAMPLE | changes
    record |= {"arrival": arrival, "arrival_time": record["timestamp"] or 0}
    return json.dumps(record)


def write_lines(folder, name: str, lines: list[str]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
