"""Column lists and types of the pipeline's tables."""

from __future__ import annotations

SUBMISSION = (
    "filename product_name price_default price_card price_discount barcode discount_amount id_sku print_datetime code additional_info color special_symbols "
    "frame_timestamp x_min y_min x_max y_max qr_code_barcode price1_qr price2_qr price3_qr price4_qr wholesale_level_1_count wholesale_level_1_price "
    "wholesale_level_2_count wholesale_level_2_price action_price_qr action_code_qr"
).split()
MOTION = "video_id string, at long, shift_x double, shift_y double, speed double, response double, sharpness double"
DETECTIONS = "video_id string, det_id long, at long, shift_x double, shift_y double, confidence double, x_min double, y_min double, x_max double, y_max double"
ZONES = "video_id string, filename string, track_id long, rank int, timestamp_ms long, frame_timestamp long, x_min double, y_min double, x_max double, y_max double, zone string, zone_mode string, target_fields array<string>"
TOKENS = "array<struct<text:string,confidence:double,box:array<array<double>>>>"
OCR = f"video_id string, track_id long, rank int, timestamp_ms long, zone string, engine string, image_kind string, image_path string, target_fields array<string>, text string, confidence double, tokens {TOKENS}"
CANDIDATES = "video_id string, track_id long, field string, value string, score double, confidence double, valid boolean, engine string, zone string, image_kind string, timestamp_ms long, source_text string, ordinal long"
CATALOG = "entry_id long, name string, code string, weight_volume string, price_regular_rub string, price_promo_rub string, url string"
TASK_EVENTS = "task_id long, kind string, at double, worker string, seq long"
TIMINGS = "step string, status string, seconds double, started_at string, finished_at string, exit_code int, message string"
